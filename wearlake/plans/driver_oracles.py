"""The same questions as SQL over the given tables."""

from __future__ import annotations

# ---- shared parts ---------------------------------------------------------------

REC = """
rec AS (
  SELECT event_id, user_id, event_type, value, ts, ts - INTERVAL 5 HOUR AS local,
         CAST(props->>'$.k' AS INTEGER) AS k,
         CASE WHEN CAST(props->>'$.k' AS INTEGER) < 90 THEN 1 ELSE 0 END AS worn,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS dos,
         CASE user_id % 8 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/St_Johns'
              WHEN 2 THEN 'Pacific/Auckland' WHEN 3 THEN 'Asia/Kolkata'
              WHEN 4 THEN 'Nowhere/Unknown' WHEN 5 THEN '' WHEN 6 THEN 'UTC'
              ELSE 'America/Sao_Paulo' END AS zone,
         CASE WHEN length(CAST(user_id AS VARCHAR)) >= 3 THEN CAST(user_id AS VARCHAR)
              ELSE lpad(CAST(user_id AS VARCHAR), 3, '0') END AS padded
  FROM events
)"""

ORDERED = f"""{REC},
pos AS (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS position FROM rec
)"""

WORN_DAYS = """
worn_days AS (
  SELECT user_id, event_type, CAST(count(*) FILTER (share > 0.9) AS INTEGER) AS actual_devdays
  FROM (SELECT user_id, event_type, CAST(local AS DATE) AS d, sum(worn) / count(*) AS share
        FROM rec GROUP BY ALL)
  GROUP BY user_id, event_type
)"""

BOUNDS = """
bounds AS (
  SELECT user_id, event_type, arg_min(ts, event_id) AS first_utc, arg_max(ts, event_id) AS last_utc,
         CAST(max(dos) + 1 AS INTEGER) AS length_per, arg_min(zone, event_id) AS zone,
         CAST(count(*) AS BIGINT) AS n_rows
  FROM rec GROUP BY user_id, event_type
)"""


def months(born: str, day: str) -> str:
    """Completed months, negative before birth."""
    span = f"((year({day}) - year({born})) * 12 + month({day}) - month({born}))"
    reached = f"CAST({born} + to_months(CAST({span} AS INTEGER)) AS DATE)"
    return (
        f"CAST(CASE WHEN {day} >= {born} THEN {span} - CASE WHEN {reached} > {day} THEN 1 ELSE 0 END "
        f"WHEN {day} < {born} THEN {span} + CASE WHEN {reached} < {day} THEN 1 ELSE 0 END END AS INTEGER)"
    )


def chronological(born: str, day: str) -> str:
    whole = months(born, day)
    left = f"date_diff('day', CAST({born} + to_months({whole}) AS DATE), {day})"
    return f"CAST({whole} + CASE WHEN {left} >= 16 THEN 1 ELSE 0 END AS INTEGER)"


def born_from(first: str) -> str:
    return f"CAST(DATE '{first}' + CAST(o_custkey % 9000 AS INTEGER) AS DATE)"


CODE = "lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(3, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0') || '--1'"

VISITS = f"""
visits AS (
  SELECT o_orderkey, {CODE} AS src_subject_id, CAST(o_orderdate AS DATE) AS interview_date,
         CASE WHEN NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')
              THEN CAST({months(born_from("1970-01-31"), "CAST(o_orderdate AS DATE)")} + o_orderkey % 3 AS INTEGER)
         END AS interview_age
  FROM orders
)"""

BIRTHS = """
births AS (
  SELECT src_subject_id, list_sort(list(b))[CAST(floor(count(*) / 2) AS INTEGER) + 1] AS birth_date
  FROM (SELECT src_subject_id, CAST(interview_date - to_months(interview_age) AS DATE) AS b
        FROM visits WHERE interview_age IS NOT NULL)
  GROUP BY src_subject_id
)"""

DEVIATIONS = f"""
seen AS (
  SELECT v.*, birth_date, {months("birth_date", "interview_date")} AS calculated_age
  FROM visits v LEFT JOIN births USING (src_subject_id)
),
graded AS (
  SELECT *, CAST(abs(calculated_age - interview_age) AS INTEGER) AS deviation FROM seen
)"""

SUBJECTS = """
subjects AS (
  SELECT CAST(floor(s_suppkey / 2) AS BIGINT) AS subject_id, arg_min(s_name, s_suppkey) AS subjectkey,
         arg_min(CASE WHEN s_nationkey % 2 = 0 THEN 'F' ELSE 'M' END, s_suppkey) AS sex
  FROM supplier GROUP BY 1
)"""

ABBREVIATION = """CASE zone WHEN 'America/New_York' THEN 'EST' WHEN 'America/St_Johns' THEN 'NST'
  WHEN 'Pacific/Auckland' THEN 'NZDT' WHEN 'Asia/Kolkata' THEN 'IST'
  WHEN 'Nowhere/Unknown' THEN 'Nowhere/Unknown' WHEN 'UTC' THEN 'UTC'
  WHEN 'America/Sao_Paulo' THEN '-03' END"""

OFFSET = """CAST(CASE zone WHEN 'America/New_York' THEN -5 WHEN 'America/St_Johns' THEN -3
  WHEN 'Asia/Kolkata' THEN 5 WHEN 'UTC' THEN 0 WHEN 'America/Sao_Paulo' THEN -3 END AS INTEGER)"""

DEVICE = "CASE WHEN subject_id BETWEEN 1 AND 83 THEN 'Empatica E4' ELSE '' END"

SIGNAL = """CASE event_type WHEN 'click' THEN 'acc' WHEN 'view' THEN 'eda' WHEN 'purchase' THEN 'ibi'
  WHEN 'signup' THEN 'temp' ELSE 'bvp' END"""

SIDE = "CASE WHEN event_id % 2 = 0 THEN 'left' ELSE 'right' END"


def converted(sensors: str, age=months) -> str:
    """CTEs up to ``conv``: the whole archive layout with the series key in front."""
    return f"""{REC}, {WORN_DAYS}, {BOUNDS}, {VISITS}, {BIRTHS}, {SUBJECTS},
conv AS (
  SELECT user_id, event_type, event_id, subjectkey, padded AS src_subject_id,
         strftime(local, '%m/%d/%Y') AS interview_date,
         {age("birth_date", "CAST(local AS DATE)")} AS interview_age, sex,
         {DEVICE.replace("subject_id", "user_id")} AS mt_pilot_vib_device,
         length_per, length_per AS max_devdays, actual_devdays,
         CAST(dos + 1 AS INTEGER) AS tlfb_daynum,
         CAST(CASE WHEN isodow(local) IN (5, 6) THEN 1 ELSE 0 END AS INTEGER) AS day_code,
         {ABBREVIATION.replace("CASE zone", "CASE bounds.zone")} AS site_time_zone,
         {OFFSET.replace("CASE zone", "CASE bounds.zone")} AS utc_offset,
         strftime(first_utc, '%m/%d/%Y') AS dc_start_date, strftime(first_utc, '%H:%M') AS dc_start_time,
         strftime(last_utc, '%m/%d/%Y') AS dc_end_date, strftime(last_utc, '%H:%M') AS dc_end_time,
         {DEVICE.replace("subject_id", "user_id")} AS watch_device_type,
         CAST(event_id % 2 AS INTEGER) AS device_position,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS device_timestamp,
         {sensors}
  FROM rec JOIN worn_days USING (user_id, event_type) JOIN bounds USING (user_id, event_type)
  LEFT JOIN subjects ON subjects.subject_id = rec.user_id
  LEFT JOIN births ON births.src_subject_id = padded || '--1'
)"""


ACC = "value AS accel_x, -value AS accel_y, CAST(k AS DOUBLE) AS accel_z"


def describe(columns: list[str]) -> str:
    parts = [
        f"""SELECT event_type, '{name}' AS "column", CAST(count({c}) AS BIGINT) AS count,
        round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
        round(CAST(min({c}) AS DOUBLE), 6) AS min,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75,
        round(CAST(max({c}) AS DOUBLE), 6) AS max
        FROM rec GROUP BY event_type"""
        for name, c in (part.split(":") for part in columns)
    ]
    return f"WITH {REC} " + " UNION ALL ".join(parts)


STEPS = f"""WITH {ORDERED},
steps AS (SELECT *, value - lag(value) OVER (PARTITION BY event_type ORDER BY event_id) AS diff FROM pos)"""

SAMPLING = f"""WITH {ORDERED},
steps AS (
  SELECT event_type, epoch_us(date_trunc('minute', local))
         - lag(epoch_us(date_trunc('minute', local))) OVER (PARTITION BY event_type ORDER BY event_id) AS step
  FROM pos
),
counted AS (SELECT event_type, step, count(*) AS n FROM steps WHERE step IS NOT NULL GROUP BY ALL),
best AS (
  SELECT event_type, step, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, step) AS r FROM counted
)
SELECT event_type, round(step / 1e6, 6) AS step_s,
       CASE WHEN step <> 0 THEN round(1.0 / (step / 1e6), 6) END AS rate_hz
FROM best WHERE r = 1"""

BAND = f"""WITH {ORDERED},
rolled AS (
  SELECT event_id, count(value) OVER w AS n, avg(value) OVER w AS m, stddev_samp(value) OVER w AS s
  FROM pos WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 10 PRECEDING AND 9 FOLLOWING)
)
SELECT event_id, CASE WHEN n = 20 THEN round(m, 6) END AS rolling_mean,
       CASE WHEN n = 20 THEN round(s, 6) END AS rolling_std,
       CASE WHEN n = 20 THEN round(m - s, 6) END AS band_lo,
       CASE WHEN n = 20 THEN round(m + s, 6) END AS band_hi
FROM rolled"""

FLAT = f"""{STEPS},
tiny AS (SELECT event_id, event_type, coalesce(abs(diff) < 5, false) AS t FROM steps),
flagged AS (
  SELECT event_id, event_type,
         t AND coalesce(lag(t) OVER w, false) AND coalesce(lead(t) OVER w, false) AS flat
  FROM tiny WINDOW w AS (PARTITION BY event_type ORDER BY event_id)
)"""

QUARTILES = """
box AS (
  SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
         quantile_cont(value, 0.75) AS q3
  FROM events GROUP BY event_type
)"""

PATHS = f"""{REC},
paths AS (
  SELECT event_id,
         CASE WHEN k % 2 = 0 THEN '/study/SP' || user_id ELSE '/study/raw' END AS folder,
         CASE WHEN k < 80 THEN 'SP' || padded || '_e4_' || {SIGNAL} || '_' || {SIDE} || '.parquet'
              ELSE 'SP' || user_id || '_RIGHT.parquet' END AS name
  FROM rec
)"""


def complete(condition: str) -> str:
    flags = {s: f"coalesce(bool_or(signal = '{s}' AND {condition}), false) AS {s}" for s in
             ("acc", "eda", "ibi", "temp")}
    seen = ", ".join(f"CASE WHEN {s} THEN '{s}' END" for s in flags)
    missing = ", ".join(f"CASE WHEN NOT {s} THEN '{s}' END" for s in flags)
    return f"""WITH {REC},
    found AS (SELECT 'SP' || user_id || '/' || dos AS folder, {SIGNAL} AS signal, {SIDE} AS side FROM rec),
    flags AS (SELECT folder, {", ".join(flags.values())} FROM found GROUP BY folder)
    SELECT folder, concat_ws(',', {seen}) AS seen, concat_ws(',', {missing}) AS missing,
           acc AND eda AND ibi AND temp AS complete FROM flags"""


def checks() -> str:
    """Every dictionary rule on the converted electrodermal layout."""
    rules = [
        ("subjectkey", "prefix", "NOT starts_with(subjectkey, 'NDAR')"),
        ("src_subject_id", "size", "length(src_subject_id) > 45"),
        ("interview_date", "type", "try_strptime(interview_date, '%m/%d/%Y') IS NULL"),
        ("interview_age", "type", "false"),
        ("interview_age", "range", "interview_age NOT BETWEEN 0 AND 1440"),
        ("sex", "size", "length(sex) > 20"),
        ("sex", "choice", "sex NOT IN ('M', 'F', 'O', 'NR')"),
        ("mt_pilot_vib_device", "size", "length(mt_pilot_vib_device) > 60"),
        ("length_per", "size", "length(CAST(length_per AS VARCHAR)) > 500"),
        ("max_devdays", "type", "false"),
        ("actual_devdays", "type", "false"),
        ("tlfb_daynum", "type", "false"),
        ("day_code", "type", "false"),
        ("day_code", "choice", "day_code NOT IN (0, 1)"),
        ("site_time_zone", "size", "length(site_time_zone) > 20"),
        ("utc_offset", "type", "false"),
        ("utc_offset", "range", "utc_offset NOT BETWEEN -11 AND 12"),
        ("dc_start_date", "type", "try_strptime(dc_start_date, '%m/%d/%Y') IS NULL"),
        ("dc_start_time", "size", "length(dc_start_time) > 5"),
        ("dc_end_date", "type", "try_strptime(dc_end_date, '%m/%d/%Y') IS NULL"),
        ("dc_end_time", "size", "length(dc_end_time) > 5"),
        ("watch_device_type", "size", "length(watch_device_type) > 100"),
        ("device_position", "type", "false"),
        ("device_position", "choice", "device_position NOT IN (0, 1)"),
        ("device_timestamp", "size", "length(device_timestamp) > 20"),
        ("eda_us", "type", "false"),
    ]
    parts = [
        f"""SELECT event_type, '{column}' AS "column", '{rule}' AS rule,
        CAST(count(*) FILTER ({column} IS NOT NULL AND {broken}) AS BIGINT) AS bad_rows,
        min(event_id) FILTER ({column} IS NOT NULL AND {broken}) AS first_bad_row,
        arg_min(CAST({column} AS VARCHAR), event_id) FILTER ({column} IS NOT NULL AND {broken}) AS sample
        FROM conv GROUP BY event_type"""
        for column, rule, broken in rules
    ]
    return f"WITH {converted('value AS eda_us')} " + " UNION ALL ".join(parts)


def template() -> str:
    dropped = "device_position, accel_x, accel_y, accel_z"
    return (
        f"WITH {converted(ACC)} SELECT * EXCLUDE (user_id, event_type, event_id, {dropped}), "
        "CAST(NULL AS DOUBLE) AS eda_us FROM conv"
    )


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

PARTICIPANTS = """WITH p AS (
  SELECT user_id AS subject_id, row_number() OVER (ORDER BY user_id) AS ordinal
  FROM (SELECT DISTINCT user_id FROM events)
)"""

def histogram(table: str, key: str, value: str) -> str:
    """Counted by the edges themselves: first bin whose upper edge lies beyond."""
    edge = "lo + (hi - lo) / 30 * {}"
    return f"""WITH l AS (SELECT {key}, min({value}) AS lo, max({value}) AS hi FROM {table} GROUP BY 1),
        e AS (SELECT {key}, CAST(g.bin AS INTEGER) AS bin, {edge.format("g.bin")} AS bin_lo,
                     CASE WHEN g.bin = 29 THEN hi ELSE {edge.format("(g.bin + 1)")} END AS bin_hi
              FROM l CROSS JOIN (SELECT unnest(range(30)) AS bin) g),
        v AS (SELECT {key}, {value} AS x, count(*) AS n FROM {table} GROUP BY ALL)
        SELECT {key}, bin, round(bin_lo, 6) AS bin_lo, round(bin_hi, 6) AS bin_hi, CAST(coalesce(sum(n), 0) AS BIGINT) AS n
        FROM e LEFT JOIN v USING ({key})
        WHERE FALSE OR TRUE
        GROUP BY {key}, bin, e.bin_lo, e.bin_hi
        """.replace("coalesce(sum(n), 0)", "coalesce(sum(n) FILTER (x >= e.bin_lo AND (x < e.bin_hi OR (bin = 29 AND x = e.bin_hi))), 0)").replace("        WHERE FALSE OR TRUE\n", "")


ORACLES = {
    "device_wear_days": f"WITH {REC}, {WORN_DAYS} SELECT * FROM worn_days",
    "series_length": f"WITH {REC}, {BOUNDS} SELECT user_id, event_type, length_per FROM bounds",
    "collection_bounds": f"""WITH {REC}, {BOUNDS} SELECT user_id, event_type,
        strftime(first_utc, '%m/%d/%Y') AS dc_start_date, strftime(first_utc, '%H:%M') AS dc_start_time,
        strftime(last_utc, '%m/%d/%Y') AS dc_end_date, strftime(last_utc, '%H:%M') AS dc_end_time
        FROM bounds""",
    "first_zone_value": f"""WITH {REC} SELECT event_type, arg_min(zone, event_id) AS timezone
        FROM rec GROUP BY event_type""",
    "series_summary": f"""WITH {REC}, {WORN_DAYS}, {BOUNDS}
        SELECT user_id, event_type, length_per, length_per AS max_devdays, actual_devdays,
               first_utc, last_utc, zone, n_rows
        FROM bounds JOIN worn_days USING (user_id, event_type)""",
    "run_report": """WITH s AS (SELECT user_id, event_type,
              CASE WHEN event_type = 'error' THEN 0 ELSE count(*) END AS n,
              CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS bad FROM events GROUP BY user_id, event_type)
        SELECT user_id, event_type, CAST(n AS BIGINT) AS n_rows, CAST(1 - bad AS BIGINT) AS n_files,
          CAST(bad AS BIGINT) AS n_failures FROM s
        UNION ALL SELECT NULL, NULL, CAST(sum(n) AS BIGINT), CAST(sum(1 - bad) AS BIGINT),
          CAST(sum(bad) AS BIGINT) FROM s""",
    "completeness": complete("true"),
    "completeness_left": complete("side = 'left'"),
    "text_fields": f"""WITH {REC} SELECT event_id, strftime(local, '%m/%d/%Y') AS interview_date,
        strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS device_timestamp FROM rec""",
    "day_code": f"""WITH {REC} SELECT event_id,
        CAST(CASE WHEN isodow(local) IN (5, 6) THEN 1 ELSE 0 END AS INTEGER) AS day_code FROM rec""",
    "study_day_number": f"WITH {REC} SELECT event_id, CAST(dos + 1 AS INTEGER) AS tlfb_daynum FROM rec",
    "parse_timestamps": f"""WITH {REC} SELECT event_id, CAST(CASE
        WHEN k < 30 THEN epoch_us(date_trunc('second', ts)) WHEN k < 60 THEN epoch_us(ts) - epoch_us(ts) % 1000
        WHEN k < 95 THEN epoch_us(ts) END AS BIGINT) AS micros FROM rec""",
    "parse_names": f"""WITH {PATHS},
        parts AS (SELECT event_id, name, regexp_extract(name, '^SP([0-9]+)', 1) AS raw,
                         string_split(name, '_') AS tok FROM paths)
        SELECT event_id, 'SP' || raw AS participant_id,
          CASE WHEN len(tok) >= 4 THEN tok[3] || '_' || replace(tok[4], '.parquet', '') ELSE 'unknown' END
            AS data_type,
          lpad(raw, CAST(greatest(3, length(raw)) AS INTEGER), '0') AS padded, CAST(raw AS BIGINT) AS subject_id,
          CAST(CASE WHEN contains(lower(name), 'left') THEN 0 WHEN contains(lower(name), 'right') THEN 1 END
            AS INTEGER) AS device_position,
          len(tok) = 4 AND tok[3] <> 'bvp' AS is_recording,
          CASE WHEN len(tok) = 4 AND tok[3] <> 'bvp' THEN tok[3] END AS signal,
          CASE WHEN len(tok) = 4 AND tok[3] <> 'bvp' THEN replace(tok[4], '.parquet', '') END AS side
        FROM parts""",
    "path_participant": f"""WITH {PATHS} SELECT event_id,
        CASE WHEN regexp_matches(folder, 'SP[0-9]+') THEN regexp_extract(folder, 'SP[0-9]+')
             ELSE 'UNKNOWN' END AS participant_id FROM paths""",
    "completed_months_signed": f"""SELECT o_orderkey,
        {months(born_from("1970-01-31"), "CAST(o_orderdate AS DATE)")} AS months,
        {months(born_from("1996-01-31"), "CAST(o_orderdate AS DATE)")} AS months_signed FROM orders""",
    "chronological_age": f"""SELECT o_orderkey,
        {chronological(born_from("1970-01-31"), "CAST(o_orderdate AS DATE)")} AS months FROM orders""",
    "birth_date": f"WITH {VISITS}, {BIRTHS} SELECT * FROM births",
    "birth_date_qc": f"""WITH {VISITS}, {BIRTHS}, {DEVIATIONS}
        SELECT src_subject_id, max(birth_date) AS birth_date, CAST(count(deviation) AS BIGINT) AS n_visits,
          CAST(count(*) FILTER (interview_age IS NULL) AS BIGINT) AS n_unusable,
          max(deviation) AS max_deviation, round(avg(deviation), 6) AS avg_deviation,
          CAST(count(*) FILTER (deviation <= 1) AS BIGINT) AS n_within,
          CASE WHEN count(deviation) > 0
               THEN round(count(*) FILTER (deviation <= 1) / count(deviation), 6) END AS acceptance_rate,
          CASE WHEN count(deviation) > 0
               THEN count(*) FILTER (deviation <= 1) / count(deviation) >= 0.8 ELSE false END AS passed
        FROM graded GROUP BY src_subject_id""",
    "visit_report": f"""WITH {VISITS}, {BIRTHS}, {DEVIATIONS}
        SELECT src_subject_id, o_orderkey, interview_date, interview_age, birth_date, calculated_age, deviation,
          CASE WHEN deviation <= 1 THEN 'ok' WHEN deviation <= 2 THEN 'warn'
               WHEN deviation IS NOT NULL THEN 'bad' END AS grade
        FROM graded""",
    "subject_metadata": f"""WITH {REC}, {SUBJECTS},
        users AS (SELECT DISTINCT CAST(user_id AS BIGINT) AS subject_id, padded AS src_subject_id FROM rec)
        SELECT subject_id, src_subject_id, subjectkey, sex, {DEVICE} AS device
        FROM users LEFT JOIN subjects USING (subject_id)""",
    "zone_dimension": f"""WITH {REC}, {BOUNDS} SELECT user_id, event_type, zone AS timezone,
        {ABBREVIATION} AS site_time_zone, {OFFSET} AS utc_offset FROM bounds""",
    "numbered_participants": f"{PARTICIPANTS} SELECT * FROM p",
    "select_participants": f"{PARTICIPANTS} SELECT * FROM p WHERE ordinal IN (1, 3, 4, 5, 12)",
    "select_participants_by_id": f"{PARTICIPANTS} SELECT * FROM p WHERE subject_id IN (0, 3, 4, 5, 12)",
    "head_limit_per_file": f"""WITH {REC} SELECT event_type, CAST(count(*) AS BIGINT) AS n_rows,
        CAST(max(dos) + 1 AS INTEGER) AS length_per FROM rec WHERE event_id < 2000 GROUP BY event_type""",
    "tail_rows": """SELECT event_type, event_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS r FROM events)
        WHERE r <= 10""",
    "row_slice": """SELECT event_id AS row_index, event_id, event_type, value FROM events
        WHERE event_id >= 25 AND event_id < 75""",
    "vertical_record": """
        SELECT event_id, 'user_id' AS "column", CAST(user_id AS VARCHAR) AS value FROM events
        UNION ALL SELECT event_id, 'event_type', event_type FROM events
        UNION ALL SELECT event_id, 'value', CAST(value AS VARCHAR) FROM events""",
    "schema_listing": """
        SELECT (SELECT CAST(count(*) AS BIGINT) FROM events) AS n_rows, CAST(6 AS INTEGER) AS n_columns,
          CAST(ordinal_position - 1 AS INTEGER) AS ordinal, column_name AS "column",
          CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
               WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS type
        FROM information_schema.columns WHERE table_name = 'events'""",
    "file_audit": " UNION ALL ".join(
        f"""SELECT '{name}.parquet' AS file_name, CAST(count(*) AS BIGINT) AS n_rows,
        CAST(count(*) AS BIGINT) AS n_scanned, true AS ok, CAST(NULL AS VARCHAR) AS problem FROM {name}"""
        for name in TABLES
    ),
    "csv_planned_files": """SELECT event_type, min(event_id) AS first_event, max(event_id) AS last_event,
        CAST(count(*) AS BIGINT) AS n FROM (
        SELECT event_type, event_id, (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 1000 AS file
        FROM events) GROUP BY event_type, file""",
    "csv_texts": "SELECT doc_id, nullif(text, '') AS text, lang FROM documents",
    "csv_records": """SELECT doc_id, nullif(text, '') AS text, lang, source,
        row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents""",
    "read_by_extension": """
        SELECT 'csv' AS kind, doc_id, 'text' AS "column", nullif(text, '') AS value FROM documents
        UNION ALL SELECT 'csv', doc_id, 'source', nullif(source, '') FROM documents
        UNION ALL SELECT 'parquet', doc_id, 'text', text FROM documents
        UNION ALL SELECT 'parquet', doc_id, 'source', source FROM documents""",
    "metadata_csv": f"""WITH {REC}, {SUBJECTS},
        users AS (SELECT DISTINCT CAST(user_id AS BIGINT) AS subject_id FROM rec)
        SELECT subject_id, subjectkey, sex FROM users JOIN subjects USING (subject_id)""",
    "visits_csv": f"WITH {VISITS}, {BIRTHS} SELECT * FROM births",
    "csv_rows": """SELECT event_type, CAST(r AS BIGINT) AS row_index, event_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS r,
               count(*) OVER (PARTITION BY event_type) AS n FROM events)
        WHERE r BETWEEN 25 AND 74 OR r >= n - 10""",
    "file_audit_damaged": """
        WITH parts AS (SELECT o_orderkey % 4 AS part, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1)
        SELECT 'good 100%+ ' || part || '.parquet' AS file_name, n AS n_rows, n AS n_scanned, true AS ok,
          CAST(NULL AS VARCHAR) AS problem FROM parts
        UNION ALL SELECT 'text ' || part || '.parquet', NULL, NULL, false, 'unreadable' FROM parts
        UNION ALL SELECT 'empty.parquet', NULL, NULL, false, 'empty'""",
    "csv_round_trip": "SELECT event_id, user_id, value, ts, event_type FROM events",
    "parquet_to_csv": "SELECT * FROM customer ORDER BY c_custkey LIMIT 1000",
    "parquet_to_csv_whole": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "convert_acc": f"WITH {converted(ACC)} SELECT * EXCLUDE (event_id) FROM conv",
    "convert_eda": f"WITH {converted('value AS eda_us')} SELECT * EXCLUDE (event_id) FROM conv",
    "convert_ibi": f"WITH {converted('value AS ibi', chronological)} SELECT * EXCLUDE (event_id) FROM conv",
    "convert_temp": f"WITH {converted('value AS skin_temp')} SELECT * EXCLUDE (event_id) FROM conv",
    "convert_older_layout": f"""WITH {converted("value AS skin_temp, k")}
        SELECT * EXCLUDE (event_id, k) REPLACE (CAST(k + 200 AS INTEGER) AS interview_age,
          'watch ' || event_type AS mt_pilot_vib_device) FROM (SELECT * EXCLUDE (watch_device_type) FROM conv)""",
    "convert_eda_salted": f"WITH {converted('value AS eda_us')} SELECT * EXCLUDE (event_id) FROM conv",
    "conform_template": template(),
    "validate_dictionary": checks(),
    "signal_summary": f"""WITH {REC} SELECT user_id, event_type, CAST(count(*) AS BIGINT) AS n_rows,
        min(local) AS min_local, max(local) AS max_local,
        arg_min(local, event_id) AS first_local, arg_max(local, event_id) AS last_local,
        round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
        round(min(value), 6) AS min, round(max(value), 6) AS max, CAST((SELECT count(*) FROM information_schema.columns WHERE table_name = 'events') AS INTEGER) AS n_columns,
        round((epoch_us(max(local)) - epoch_us(min(local))) / 1e6, 6) AS duration_s,
        round((epoch_us(arg_max(local, event_id)) - epoch_us(arg_min(local, event_id))) / 1e6, 6) AS extent_s,
        round(max(value) - min(value), 6) AS range
        FROM rec GROUP BY user_id, event_type""",
    "sampling_rate": SAMPLING,
    "sampling_rate_chunked": SAMPLING,
    "distinct_values": f"""WITH {REC}
        SELECT event_type, 'timezone' AS "column", zone AS value, min(event_id) AS first_row FROM rec GROUP BY ALL
        UNION ALL SELECT event_type, 'day_of_study', CAST(dos AS VARCHAR), min(event_id) FROM rec GROUP BY ALL
        UNION ALL SELECT event_type, 'device_worn', CAST(worn AS VARCHAR), min(event_id) FROM rec GROUP BY ALL""",
    "describe_numeric": describe(["value:value", "k:k", "day_of_study:dos"]),
    "describe_numeric_ranked": describe(["value:value", "k:k"]),
    "percentiles_lineitem": """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.1), 6) AS p10,
        round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
        round(quantile_cont(l_extendedprice, 0.99), 6) AS p99
        FROM lineitem GROUP BY l_returnflag""",
    "histogram30": histogram("events", "event_type", "value"),
    "histogram_edges": histogram("lineitem", "l_returnflag", "l_discount"),
    "box_stats": f"""WITH {QUARTILES},
        x AS (SELECT event_type, q1, median, q3, value,
                     value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
              FROM events JOIN box USING (event_type))
        SELECT event_type, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
          round(least(min(value) FILTER (inside), q1), 6) AS whisker_lo,
          round(greatest(max(value) FILTER (inside), q3), 6) AS whisker_hi,
          CAST(count(*) FILTER (NOT inside) AS BIGINT) AS n_outliers, CAST(count(*) AS BIGINT) AS n
        FROM x GROUP BY event_type, q1, median, q3""",
    "box_outliers": f"""WITH {QUARTILES} SELECT event_type, event_id, value
        FROM events JOIN box USING (event_type)
        WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""",
    "sparse_positions": """SELECT event_type, event_id,
        row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS position FROM events""",
    "differences": f"{STEPS} SELECT event_id, round(diff, 6) AS diff FROM steps",
    "rolling_band": BAND,
    "rolling_band_chunked": BAND,
    "high_variation": f"""{STEPS},
        spread AS (SELECT event_type, stddev_samp(abs(diff)) AS s FROM steps GROUP BY event_type)
        SELECT event_type, CAST(count(*) FILTER (abs(diff) > 2 * s) AS BIGINT) AS n_high,
          CAST(count(*) AS BIGINT) AS n_rows,
          round(count(*) FILTER (abs(diff) > 2 * s) / count(*) * 100, 6) AS pct_high
        FROM steps JOIN spread USING (event_type) GROUP BY event_type""",
    "flat_points": f"{FLAT} SELECT event_id, flat FROM flagged",
    "flat_count": f"""{FLAT} SELECT event_type, CAST(count(*) FILTER (flat) AS BIGINT) AS n_flat
        FROM flagged GROUP BY event_type""",
}

HOLED = f"""{REC.replace("rec AS", "seen AS", 1)},
rec AS (SELECT * REPLACE (CASE WHEN k % 10 > 1 THEN value END AS value) FROM seen)"""

ORACLES["describe_nan"] = ORACLES["describe_numeric_ranked"].replace(REC, HOLED).split(" UNION ALL ")[0]
ORACLES["histogram_nan"] = f"WITH {HOLED}, held AS (SELECT * FROM rec WHERE value IS NOT NULL)" + ORACLES[
    "histogram30"
].replace("WITH l AS", ", l AS", 1).replace("FROM events", "FROM held")
ORACLES["box_nan"] = f"WITH {HOLED}, held AS (SELECT * FROM rec WHERE value IS NOT NULL)" + ORACLES["box_stats"].replace(
    "WITH ", ", ", 1
).replace("FROM events", "FROM held")
ORACLES["summary_nan"] = (
    ORACLES["signal_summary"]
    .replace(REC, HOLED)
    .replace("user_id, event_type", "event_type")
    .replace("(SELECT count(*) FROM information_schema.columns WHERE table_name = 'events')", "4")
)
ORACLES["rolling_nan"] = BAND.replace(
    REC,
    f"""{HOLED.replace("rec AS (SELECT * REPLACE", "part AS (SELECT * REPLACE", 1)},
rec AS (SELECT * REPLACE (CASE WHEN event_id % 1000 < 700 THEN value ELSE 1e7 + event_id % 17 END AS value) FROM part)""",
).replace(", 6)", ", 5)")

STUDY = f"""{REC},
placed AS (
  SELECT user_id % 12 + 1 AS p, {SIGNAL} AS signal, CASE WHEN event_id % 2 = 0 THEN 'left' ELSE 'right' END AS side,
         event_id, value, worn FROM rec
)"""

ORACLES["study_files"] = f"""WITH {STUDY}
SELECT 'SP' || p AS folder, 'SP' || p || '_e4_' || signal || '_' || side || '.parquet' AS file_name,
       true AS readable, CAST(count(*) AS BIGINT) AS n_rows FROM placed GROUP BY p, signal, side
UNION ALL SELECT 'SP1', 'SP1_e4_eda_left_old.parquet', false, NULL
UNION ALL SELECT 'SP13', NULL, false, NULL"""
ORACLES["study_scan"] = f"""WITH {STUDY}
SELECT 'SP' || p AS participant_id, CAST(p AS BIGINT) AS subject_id, side,
       row_number() OVER (PARTITION BY p, side ORDER BY event_id) - 1 AS row_index,
       value AS eda, CAST(worn AS INTEGER) AS device_worn FROM placed WHERE signal = 'eda'"""
ORACLES["study_report"] = f"""WITH {STUDY},
sides AS (SELECT p, signal, side, CAST(count(*) AS BIGINT) AS n FROM placed WHERE signal <> 'bvp' GROUP BY 1, 2, 3),
whole AS (SELECT p, count(DISTINCT signal) = 4 AS complete FROM sides GROUP BY 1)
SELECT 'SP' || p AS participant_id, signal, side, n AS n_rows, true AS ok, false AS misplaced, complete,
       CASE WHEN NOT complete THEN 0 WHEN signal = 'acc' THEN least(n, 100) ELSE n END AS n_written
FROM sides JOIN whole USING (p)"""

ORACLES["signal_report"] = f"""
SELECT * FROM (
    WITH {REC}, m AS (SELECT *, date_trunc('minute', local) AS minute FROM rec)
    SELECT event_type, CAST(count(*) AS BIGINT) AS n_rows, min(minute) AS min_local, max(minute) AS max_local,
        arg_min(minute, event_id) AS first_local, arg_max(minute, event_id) AS last_local,
        round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
        round(min(value), 6) AS min, round(max(value), 6) AS max,
        CAST((SELECT count(*) FROM information_schema.columns WHERE table_name = 'events') AS INTEGER) AS n_columns,
        round((epoch_us(max(minute)) - epoch_us(min(minute))) / 1e6, 6) AS duration_s,
        round((epoch_us(arg_max(minute, event_id)) - epoch_us(arg_min(minute, event_id))) / 1e6, 6) AS extent_s,
        round(max(value) - min(value), 6) AS range
    FROM m GROUP BY event_type
) JOIN ({ORACLES["sampling_rate"]}) USING (event_type)
JOIN (SELECT * EXCLUDE (n) FROM ({ORACLES["box_stats"]})) USING (event_type)
JOIN (SELECT * EXCLUDE (n_rows) FROM ({ORACLES["high_variation"]})) USING (event_type)
JOIN ({ORACLES["flat_count"]}) USING (event_type)
"""
