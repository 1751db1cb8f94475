"""Benchmark decontamination by templates.

Texts are brought to a canonical form in which numbers, units after numbers and names
(all words in Xx case) are typed placeholders, and to a second one in lower case in which
numbers alone are. Hashes of the windows of a benchmark item's templates are joined with
those of all documents. For a document and an item that share half of a template's
windows, or a run of 13 tokens, the values behind the placeholders are lined up: the
question is the same one if equal values of the item always stand for equal values of the
document, be they the item's own (``verbatim``) or others (``reparameterised``).

A window has 8 tokens, or more until 5 of them are ordinary words. Items without such a
window (shorter ones, or with fewer ordinary words) are looked for by windows of their
words and numbers as they stand, in lower case, of 8 tokens or of the item's length, so
only verbatim copies of these are found; an item of one word is found wherever that word is.

Everything is DataFrame code. Defined results: null texts, and texts without a letter or
a number, have no windows; null ids of items are never found. A document with a null id
is never reported. Of rows that repeat a document's id, the text that shares most is
reported; items that repeat an id count as one text with all their windows. Other columns
do not matter.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearlake.llm.common import kept

WINDOW = 8
# A window of placeholders alone says nothing: it grows until it holds so many ordinary words.
LEAST_PLAIN = 5
# The share of an item's windows that a document has to share.
LEAST_SHARE = 0.5
# Or so many windows of one shift, 13 tokens in a row.
LEAST_RUN = 6
# The share of an item's values that have to be replaced consistently.
LEAST_CONSISTENT = 0.8
# Hashes of item windows are broadcast up to this number (16 bytes each), joined by
# shuffling beyond it.
BROADCAST_HASHES = 2_000_000
# Up to so many item windows, their first two codes are listed: a place of a document is
# hashed only if a window begins like that. Beyond it all places are hashed.
LISTED_BEGINS = 200_000

# Placeholders. All digits go, so these three tokens are free.
NUMBER, NAME, UNIT = "0", "1", "2"
# Repeated groups are possessive: these the regex engine steps through, others it enters once
# a repeat, and some 1,200 repeats in a text overflow the stack, which ends the executor.
_NUMBER = r"\p{Nd}+(?:[.,:/]\p{Nd}+)*+"
_UNIT = (
    r"( 0 )\s*(km|cm|mm|m|kg|mg|g|t|lb|lbs|oz|miles?|feet|foot|inch(?:es)?|yards?|met(?:er|re)s?|kilomet(?:er|re)s?"
    r"|grams?|kilograms?|tons?|lit(?:er|re)s?|l|ml|gallons?|hours?|hrs?|h|minutes?|min|seconds?|sec|s|days?|weeks?"
    r"|months?|years?|dollars?|euros?|cents?|pounds?|percent|[$€£%°])(?![\p{L}])"
)
_NAME = r"(?<![\p{L}\p{M}])\p{Lu}\p{Ll}+(?:\s+\p{Lu}\p{Ll}+)*+"
# Kinds of tokens: all placeholders, numbers alone as placeholders, words and numbers as they stand.
TYPED, NUMBERED, EXACT = 1, 2, 3
_PLACEHOLDERS = {TYPED: (NUMBER, NAME, UNIT), NUMBERED: (NUMBER,)}


def _numbered(text: Column) -> Column:
    return F.regexp_replace(text, _NUMBER, " 0 ")


def _measured(text: Column) -> Column:
    return F.regexp_replace(_numbered(text), _UNIT, "$1 2 ")


def _parted(text: Column, kept_signs: str) -> Column:
    inner = F.btrim(F.regexp_replace(F.lower(text), rf"[^\p{{L}}\p{{M}}{kept_signs}]+", " "))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, " "))


def template(text: Column, kind: int = TYPED) -> Column:
    """The tokens of the canonical form; none for null."""
    given = F.coalesce(text, F.lit(""))
    if kind == TYPED:
        return _parted(F.regexp_replace(_measured(given), _NAME, " 1 "), "0-2")
    return _parted(_numbered(given), "0") if kind == NUMBERED else _parted(given, r"\p{N}")


def _coded(text: Column, kind: int) -> Column:
    """Hashes of the tokens; windows are hashed from these."""
    return F.transform(template(text, kind), lambda x: F.xxhash64(x))


def _with_codes(texts: DataFrame, kinds: Iterable[int]) -> DataFrame:
    """Adds the codes of each kind of ``text`` as ``k`` and the kind; numbers are looked for once."""
    given = texts.withColumn("_numbered", _numbered(F.coalesce(F.col("text"), F.lit(""))))
    measured = F.regexp_replace("_numbered", _UNIT, "$1 2 ")
    tokens = {
        TYPED: _parted(F.regexp_replace(measured, _NAME, " 1 "), "0-2"),
        NUMBERED: _parted(F.col("_numbered"), "0"),
        EXACT: template(F.col("text"), EXACT),
    }
    coded = {f"k{kind}": F.transform(tokens[kind], lambda x: F.xxhash64(x)) for kind in kinds}
    return given.withColumns(coded).drop("_numbered")


def _begin(codes: str, at: str, size: int) -> str:
    """What a window of ``size`` tokens at place ``at`` (from 1) begins with: its first codes as one number."""
    first = f"{codes}[{at} - 1]"
    return first if size == 1 else f"({first} ^ shiftleft({codes}[{at}], 1))"


def _begun(codes: str, size: int, starts: str, begins: list[int] | None) -> str:
    """Of the places ``starts`` those where a window of an item may begin."""
    if begins is None:
        return starts
    listed = ", ".join(f"{x}L" for x in begins)
    return f"filter({starts}, i -> {_begin(codes, 'i', size)} IN ({listed}))" if begins else "CAST(array() AS ARRAY<INT>)"


def _is_plain(kind: int) -> str:
    return f"NOT IN ({', '.join(f'xxhash64({x!r})' for x in _PLACEHOLDERS[kind])})"


def _grown(codes: str, kind: int, longest: int, at: str) -> str:
    """Tokens from place ``at`` (from 1) up to the last ordinary word needed; null if there are too few."""
    return f"""get(filter(transform(slice({codes}, {at}, {longest}), (x, n) -> CASE WHEN x {_is_plain(kind)} THEN n + 1 END),
                       n -> n IS NOT NULL), {LEAST_PLAIN - 1})"""


def _windows(codes: str, kind: int, starts: str, length: str) -> str:
    """``kind``, ``at``, ``length`` and ``hash`` of the windows at ``starts`` (from 1), as SQL.

    ``length`` is an expression of the place ``i``; where it is null there is no window.
    """
    return f"""transform(filter(transform({starts}, i -> named_struct('i', i, 'length', CAST({length} AS INT))), w -> w.length IS NOT NULL),
        w -> named_struct('kind', {kind}, 'at', w.i - 1, 'length', w.length, 'hash', xxhash64({kind}, slice({codes}, w.i, w.length))))"""


def _places(codes: str, size: int) -> str:
    return f"CASE WHEN size({codes}) < {size} THEN CAST(array() AS ARRAY<INT>) ELSE sequence(1, size({codes}) - {size - 1}) END"


def _own_windows(codes: str, kind: int, longest: int) -> str:
    """Windows that say something: of ``WINDOW`` tokens, or more until ``LEAST_PLAIN`` of them are ordinary words.

    A window depends on its own tokens only, so equal passages have equal windows.
    """
    length = f"greatest({WINDOW}, {_grown(codes, kind, longest, 'i')})"
    enough = f"CASE WHEN {_grown(codes, kind, longest, 'i')} IS NOT NULL THEN {length} END"
    return _windows(codes, kind, _places(codes, WINDOW), enough)


def _all_windows(codes: str, kind: int, size: int, begins: list[int] | None) -> str:
    """``kind``, ``at`` and ``hash`` of the runs of ``size`` tokens that begin as a window of an item does."""
    return f"""transform({_begun(codes, size, _places(codes, size), begins)}, i -> named_struct('kind', {kind}, 'at', i - 1, 'hash', xxhash64({kind}, slice({codes}, i, {size}))))"""


def _long_windows(codes: str, kind: int, longest: int, begins: list[int] | None) -> str:
    """``kind``, ``at`` and ``hash`` of the windows that had to grow.

    Only a place with so many placeholders near that a window lacks words is looked at;
    ``q{kind}`` are the places of placeholders.
    """
    q, more = f"q{kind}", WINDOW - LEAST_PLAIN
    starts = f"""CASE WHEN size({q}) <= {more} THEN CAST(array() AS ARRAY<INT>) ELSE array_distinct(flatten(transform(
        sequence(0, size({q}) - {more + 1}),
        k -> CASE WHEN {q}[k + {more}] - {q}[k] < {WINDOW} THEN sequence(greatest(1, {q}[k + {more}] - {WINDOW - 2}), {q}[k] + 1)
             ELSE CAST(array() AS ARRAY<INT>) END))) END"""
    grown = _windows(codes, kind, _begun(codes, WINDOW, starts, begins), _grown(codes, kind, longest, "i"))
    return f"transform({grown}, w -> named_struct('kind', w.kind, 'at', w.at, 'hash', w.hash))"


def item_windows(items: DataFrame) -> DataFrame:
    """``item_id``, ``kind``, ``at``, ``length``, ``upto``, ``hash``, ``n_windows`` and ``begin`` of an item's windows.

    ``upto`` is the last token the window speaks for: its own, or the item's if no window
    follows. Items without a window that says something have windows of exact tokens.
    """
    kinds = (TYPED, NUMBERED, EXACT)
    given = _with_codes(items.where(F.col("item_id").isNotNull()).select("item_id", "text"), kinds).drop("text")
    # No window of an item is longer than the item.
    longest = given.agg(F.max(F.greatest(F.size(f"k{TYPED}"), F.size(f"k{NUMBERED}")))).first()[0] or WINDOW
    said = F.expr(f"concat({', '.join(_own_windows(f'k{kind}', kind, max(longest, WINDOW)) for kind in _PLACEHOLDERS)})")
    exact = f"k{EXACT}"
    size = f"least({WINDOW}, size({exact}))"
    own = F.expr(f"CASE WHEN size({exact}) > 0 THEN {_windows(exact, EXACT, f'sequence(1, size({exact}) - {size} + 1)', size)} END")
    cut = given.withColumn("said", said)
    each = cut.select("*", F.explode(F.when(F.size("said") > 0, F.col("said")).otherwise(own)).alias("w"))
    last = F.expr(f"size(CASE w.kind WHEN {TYPED} THEN k{TYPED} WHEN {NUMBERED} THEN k{NUMBERED} ELSE {exact} END) - 1")
    # The first two codes of a window, or its only one.
    begin = [f"CASE WHEN w.length = 1 THEN {_begin(f'k{kind}', '(w.at + 1)', 1)} ELSE {_begin(f'k{kind}', '(w.at + 1)', 2)} END" for kind in kinds]
    begins = F.expr(f"CASE w.kind WHEN {TYPED} THEN {begin[0]} WHEN {NUMBERED} THEN {begin[1]} ELSE {begin[2]} END")
    each = each.select("item_id", "w.*", last.alias("last"), begins.alias("begin")).distinct()
    total = each.groupBy("item_id", "kind").agg(
        F.count("*").alias("n_windows"), F.max(F.struct("last", "at")).alias("end")
    )
    upto = F.when((F.col("end.at") == F.col("at")) & (F.col("end.last") == F.col("last")), F.col("last")).otherwise(
        F.col("at") + F.col("length") - 1
    )
    return each.join(total, ["item_id", "kind"]).select(
        "item_id", "kind", "at", "length", upto.alias("upto"), "hash", "n_windows", "begin"
    )


def _document_windows(docs: DataFrame, asked: dict[int, list[int]], begins: dict[tuple[int, bool], list[int]] | None) -> DataFrame:
    """Windows of the kinds and lengths that ``asked`` names, where ``begins`` lets one begin."""
    cut = _with_codes(docs, asked).drop("text")
    parts = []
    for kind, lengths in asked.items():
        for n in lengths if kind == EXACT else [WINDOW]:
            parts.append(_all_windows(f"k{kind}", kind, n, None if begins is None else begins.get((kind, n == 1), [])))
        if kind != EXACT and max(lengths) > WINDOW:
            places = f"filter(transform(k{kind}, (x, i) -> CASE WHEN NOT (x {_is_plain(kind)}) THEN i END), i -> i IS NOT NULL)"
            cut = cut.withColumn(f"q{kind}", F.expr(places))
            found = None if begins is None else begins.get((kind, False), [])
            parts.append(_long_windows(f"k{kind}", kind, max(lengths), found))
    if not parts:
        return docs.select("doc_id", "t", F.expr("0 AS kind"), F.expr("0 AS at"), F.expr("0L AS hash")).limit(0)
    each = cut.select("doc_id", "t", F.explode(F.expr(f"concat({', '.join(parts)})")).alias("w"))
    return each.select("doc_id", "t", "w.*")


def _slots(texts: DataFrame, *key: str) -> DataFrame:
    """``key``, ``kind``, token place, type and value of every placeholder of a text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = texts.distinct().select(
        *key,
        template(F.col("text"), TYPED).alias("typed"),
        template(F.col("text"), NUMBERED).alias("numbered"),
        F.regexp_extract_all(text, F.lit(_NUMBER), F.lit(0)).alias("numbers"),
        F.regexp_extract_all(_numbered(text), F.lit(_UNIT), F.lit(2)).alias("units"),
        F.transform(
            F.regexp_extract_all(_measured(text), F.lit(_NAME), F.lit(0)), lambda x: F.regexp_replace(x, r"\s+", " ")
        ).alias("names"),
    )
    # The n-th token of a type stands for the n-th value of that type.
    types = [
        (TYPED, "typed", NUMBER, "numbers"), (TYPED, "typed", UNIT, "units"), (TYPED, "typed", NAME, "names"),
        (NUMBERED, "numbered", NUMBER, "numbers"),
    ]
    zipped = [
        f"transform(arrays_zip(filter(transform({tokens}, (x, i) -> CASE WHEN x = '{type_}' THEN i END), p -> p IS NOT NULL),"
        f" {values}), z -> named_struct('kind', {kind}, 'at', z.`0`, 'type', '{type_}', 'value', z.{values}))"
        for kind, tokens, type_, values in types
    ]
    return found.select(*key, F.explode(F.expr(f"concat({', '.join(zipped)})")).alias("s")).select(*key, "s.*")


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs of documents and items whose template they share.

    ``doc_id``, ``item_id``, ``n_shared`` (windows of the item found), ``n_windows``,
    ``n_slots``, ``n_changed`` (values that differ), ``consistent`` (share of the item's
    values that always stand for one value), ``verdict`` (verbatim, reparameterised or
    inconsistent).
    """
    wanted = kept(item_windows(items))
    lengths = wanted.groupBy("kind").agg(F.collect_set("length").alias("lengths"), F.count_distinct("hash").alias("n")).collect()
    asked = {r.kind: sorted(r.lengths) for r in sorted(lengths)}
    begins: dict[tuple[int, bool], list[int]] | None = None
    if sum(r.n for r in lengths) <= LISTED_BEGINS:
        begins = {}
        for r in wanted.select("kind", (F.col("length") == 1).alias("one"), "begin").distinct().collect():
            begins.setdefault((r.kind, r.one), []).append(r.begin)
    hashes = wanted.select("hash").distinct()
    if sum(r.n for r in lengths) <= BROADCAST_HASHES:
        hashes = F.broadcast(hashes)
    pair = ["doc_id", "t", "item_id", "kind"]
    texts = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.xxhash64("text").alias("t"), "text")
    hits = kept(_document_windows(texts, asked, begins).join(hashes, "hash", "left_semi").distinct())
    # A document that repeats a passage meets each window of the item there; one place
    # for each shift is enough for lining up, so pairs stay within a document.
    met = hits.join(wanted.withColumnRenamed("at", "here"), ["kind", "hash"]).select(
        *pair, "here", "upto", (F.col("at") - F.col("here")).alias("shift"), "n_windows"
    )
    shared = met.groupBy(*pair, "n_windows").agg(F.count_distinct("here").alias("n_shared"))
    runs = met.groupBy(*pair, "shift").agg(F.count_distinct("here").alias("run")).groupBy(*pair).agg(F.max("run").alias("run"))
    whole = F.col("n_shared") >= LEAST_SHARE * F.col("n_windows")
    enough = kept(shared.join(runs, pair).where(whole | (F.col("run") >= LEAST_RUN)).drop("run"))
    aligned = met.join(enough.select(*pair), pair, "left_semi")
    ranges = aligned.groupBy(*pair, "shift").agg(F.min("here").alias("low"), F.max("upto").alias("high"))
    their = _slots(texts.join(enough.select("doc_id", "t").distinct(), ["doc_id", "t"], "left_semi"), "doc_id", "t")
    ours = _slots(items.select("item_id", "text").join(enough.select("item_id").distinct(), "item_id", "left_semi"), "item_id")
    lined = (
        ranges.join(ours.withColumnsRenamed({"value": "own", "at": "place"}), ["item_id", "kind"])
        .where("place BETWEEN low AND high")
        .withColumn("at", F.col("place") + F.col("shift"))
        .join(their, ["doc_id", "t", "kind", "at", "type"])
    )
    # One value of the item in one document: how many values stand there instead.
    values = lined.groupBy(*pair, "shift", "type", "own").agg(
        F.count_distinct("value").alias("meanings"), F.bool_or(F.lower("value") != F.lower("own")).alias("changed")
    )
    checked = values.groupBy(*pair).agg(
        F.count("*").alias("n_slots"),
        F.count_if(F.col("changed")).alias("n_changed"),
        F.avg((F.col("meanings") == 1).cast("int")).alias("consistent"),
    )
    verdict = (
        F.when(F.col("n_changed") == 0, "verbatim")
        .when(F.col("consistent") >= LEAST_CONSISTENT, "reparameterised")
        .otherwise("inconsistent")
    )
    filled = enough.join(checked, pair, "left").withColumns(
        {
            "n_slots": F.coalesce("n_slots", F.lit(0)),
            "n_changed": F.coalesce("n_changed", F.lit(0)),
            "consistent": F.coalesce("consistent", F.lit(1.0)),
        }
    )
    judged = filled.withColumn("verdict", verdict)
    told = F.struct("n_shared", "n_windows", "n_slots", "n_changed", "consistent", "verdict")
    # All placeholders tell most, unless the words and numbers of the whole item are there.
    counts = F.col("verdict") != "inconsistent"
    same = (F.col("kind") != TYPED) & (F.col("verdict") == "verbatim") & (F.col("n_shared") == F.col("n_windows"))
    by_text = judged.groupBy("doc_id", "item_id", "t").agg(
        F.max_by(told, F.struct(counts, same, -F.col("kind"))).alias("best")
    )
    # Of rows that repeat an id, the text that shares most speaks for it.
    share = F.col("best.n_shared") / F.col("best.n_windows")
    most = F.struct(F.col("best.verdict") != "inconsistent", share, F.col("best.verdict") == "verbatim", "t")
    found = by_text.groupBy("doc_id", "item_id").agg(F.max_by("best", most).alias("best"))
    return found.select("doc_id", "item_id", "best.*")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, verbatim or with other values."""
    found = matches(docs, items).where("verdict <> 'inconsistent'")
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
