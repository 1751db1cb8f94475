"""Each operator on small tables: plain cases next to brute force, and odd rows."""

import base64
import hashlib
import math
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from wearlake.llm import (
    bpe,
    chat,
    components,
    decontaminate,
    language_model,
    line_dedup,
    minhash,
    quality_model,
    quality_rules,
    suffix_dedup,
    url_lists,
)
from wearlake.llm.common import fresh

DOCS = "doc_id long, text string, lang string"


def made(words, seed, count):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) for _ in range(count))


WORDS = ["the", "of", "stone", "river", "a", "green", "quick", "letter", "ñandú", "über", "zebra", "and"]


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, long, repeated and tied rows, and columns with awkward names."""
    long_text = made(WORDS, 1, 30_000)
    rows = [
        (1, None, "en"), (2, "", "en"), (3, " \t\n ", None), (4, long_text, "en"), (5, long_text, "de"),
        (None, "a text without an id that is long enough to count " * 3, "en"),
        (6, "Same text.", "en"), (6, "Same text.", "en"), (7, "x" * 5000, "en"), (8, "<|im_end|>   \x0b end", "en"),
    ]
    wide = spark.createDataFrame(rows, DOCS)
    clash = ["_w", "_h", "_d", "_t", "_found", "_cut", "_row", "n_words", "kept", "x", "score", "ids", "spans", "_pieces_",
             "_pieces", "_hits", "_hit", "_gone", "v"]
    return wide.withColumns({name: F.lit(i) for i, name in enumerate(clash)})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def vocabulary(spark):
    return bpe.Vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


# ---- byte-level BPE -----------------------------------------------------------------


def reference_encoding():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_and_decodes(spark, odd, vocabulary):
    known = reference_encoding()
    found = bpe.decode(bpe.encode(odd, vocabulary), vocabulary).collect()
    assert len(found) == odd.count()
    for row in found:
        assert row.ids == known.encode_ordinary(row.text or "")
        assert bytes(row.content) == (row.text or "").encode()


def test_bpe_merges_without_the_whole_word(vocabulary):
    """The model alone gives every token back whole, so the shortcut changes nothing."""
    tokens, model, pattern = vocabulary.shared.value
    codec = bpe.Codec(tokens, model, pattern)
    whole = codec.pieces.encode(["".join(codec.mapped[b] for b in token) for token in tokens])
    odd_ones = [i for i, ids in enumerate(whole) if ids != [i]]
    # A token that merges cannot reach is only found by the shortcut, as in the library.
    assert len(odd_ones) < len(tokens) // 100


def test_bpe_empty_table_and_null_ids(spark, none, vocabulary):
    assert bpe.decode(bpe.encode(none, vocabulary), vocabulary).collect() == []
    ids = spark.createDataFrame([(None,), ([None, 0, 1],)], "ids array<int>")
    tokens = vocabulary.shared.value[0]
    assert [bytes(r.content) for r in bpe.decode(ids, vocabulary).collect()] == [b"", tokens[0] + tokens[1]]


# ---- subword lattice ----------------------------------------------------------------


def segmentations(word, pieces):
    """Probability of a word by listing every segmentation."""

    def inner(rest):
        if not rest:
            return 1.0
        total = 0.0
        for k in range(1, len(rest) + 1):
            piece = pieces.inners.get(rest[:k])
            if piece is not None:
                total += math.exp(pieces.log[piece]) * inner(rest[k:])
        if rest[0] not in pieces.inners:
            size = len(rest[0].encode())
            total += (math.exp(pieces.log[pieces.byte]) / 256) ** size * inner(rest[1:])
        return total

    return sum(math.exp(pieces.log[i]) * inner(word[len(head) :]) for head, i in pieces.heads.items() if word.startswith(head))


def test_forward_recursion_sums_all_segmentations():
    pieces = language_model.Pieces.read(public_tokenizers.path("piece_bpe_32k.model"))
    for word in ("the", "thereof", "a☃b", "zzz", "", "ñandú"):
        assert math.isclose(pieces.likelihood([word])[0], math.log(segmentations(word, pieces)), rel_tol=1e-9)


def test_scores_of_odd_rows(spark, odd, none):
    path = public_tokenizers.path("piece_bpe_32k.model")
    marked = odd.drop("score").withColumn("training", F.col("doc_id") != 5)
    for hot in (100_000, 3):
        found = language_model.score(marked, path, hot_words=hot, rounds=1).collect()
        words = Counter()
        training = [r for r in marked.collect() if r.training is not False]
        for r in training:
            words.update([*language_model.word_list(r.text), "END"])
        total, different = sum(words.values()), len(words)
        assert len(found) == odd.count()
        texts = {r.doc_id: r.text for r in odd.collect()}
        assert {r.doc_id for r in found} == set(texts)
        for r in found:
            text = texts[r.doc_id]
            tokens = [*language_model.word_list(text), "END"]
            base = sum(math.log10((words[t] + 0.1) / (total + 0.1 * (different + 1))) for t in tokens)
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(words[t] > 0 for t in tokens), total)
            assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    empty = none.withColumn("training", F.lit(True))
    assert language_model.score(empty, path, rounds=1).collect() == []


# ---- decontamination ----------------------------------------------------------------


ITEM = "A train leaves the old station at 9 with 120 passengers, and Maria Gomez walks 5 km to meet it before 9 again today."


def test_templates_and_slots(spark, none):
    changed = ITEM.replace("9", "11").replace("120", "75").replace("Maria Gomez", "Paul").replace("5 km", "8 miles")
    mixed = changed.replace("before 11", "before 300").replace("75", "11")
    docs = spark.createDataFrame(
        [
            (1, "Before it. " + ITEM + " After it.", "en"), (2, changed, "en"), (3, mixed, "en"), (4, None, "en"),
            (5, "", "en"), (6, made(WORDS, 3, 300), "en"), (None, ITEM, "en"), (7, ITEM.upper(), "en"), (1, ITEM, "en"),
        ],
        DOCS,
    ).withColumn("item_id", F.lit(9))
    items = spark.createDataFrame([(10, ITEM), (11, None), (12, "too short"), (None, ITEM), (13, "1 2 3 4 5 6 7 8 9 10")], "item_id long, text string")
    found = {r.doc_id: r.verdict for r in decontaminate.matches(docs.drop("item_id"), items).collect() if r.item_id == 10}
    assert found[1] == "verbatim" and found[2] == "reparameterised" and set(found) <= {1, 2, 3, 7}
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns
    assert {4, 5, 6, None} <= {r.doc_id for r in left.collect()} and not {1, 2} & {r.doc_id for r in left.collect()}
    assert decontaminate.matches(none, items).collect() == []
    assert decontaminate.clean(docs, items.limit(0)).count() == docs.count()


DENSE = "Each week Tom earns $15, Anna earns $20, Paul earns $25 and Maria earns $30, minus $5, $6, $7 and $8 in tax."
SUM = "Compute 12 + 7 - 5 + 3 + 9 - 2 + 8 + 4 - 6 + 1"


def verdicts(spark, items, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    frame = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r.verdict for r in decontaminate.matches(docs, frame).collect()}


def test_items_dense_in_numbers(spark):
    other = DENSE
    for old, new in (("15", "35"), ("20", "40"), ("25", "45"), ("30", "50"), ("Tom", "Ada"), ("Anna", "Berta"), ("$8", "$1")):
        other = other.replace(old, new)
    texts = ["Before. " + DENSE + " After.", other, "So: " + SUM + " and so on.", SUM.replace("7", "70"), " ".join("1" * 60)]
    found = verdicts(spark, [DENSE, SUM], texts)
    assert found == {(0, 0): "verbatim", (1, 0): "reparameterised", (2, 1): "verbatim"}


NAMES = (
    "When Tom met Anna near the old mill, Paul and Maria were rowing with Peter while Clara painted and Oscar slept; "
    "later Nina told Simon that Bruno had lost everything."
)


def test_items_in_other_case_and_wrapped(spark):
    wrapped = NAMES
    for name in ("Anna", "Maria", "Clara", "Simon"):
        wrapped = wrapped.replace(" " + name, "\n " + name)
    first = "Tom has many red apples in the basket. Anna takes some of them home. Paul eats the rest at night."
    texts = [NAMES, wrapped, NAMES.lower(), ITEM.upper(), first.replace("Tom", "Berta").replace("Anna", "Ivo").replace("Paul", "Ada")]
    found = verdicts(spark, [NAMES, ITEM, first], texts)
    assert found == {(0, 0): "verbatim", (1, 0): "verbatim", (2, 0): "verbatim", (3, 1): "verbatim", (4, 2): "reparameterised"}


def test_parts_of_items_and_short_items(spark):
    long_item = " ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(59))
    part = long_item.split()
    short = "What is the capital of France?"
    texts = [
        "x " + " ".join(part[20:50]) + " y", " ".join(part[7:20]), " ".join(part[7:19]),
        "He asked: what is the\ncapital of France? Paris.", "What is the capital of Spain?",
    ]
    assert verdicts(spark, [long_item, short, "?!"], texts) == {(0, 0): "verbatim", (1, 0): "verbatim", (3, 1): "verbatim"}


def test_long_runs_of_names_and_numbers(spark):
    """Names in a row, and a number of many groups, that overflowed the stack of a task."""
    names, number = "Von " * 20_000, "1" + ".12" * 20_000
    assert verdicts(spark, [ITEM], [f"{names}, {number} then. {ITEM} After {names}", names, number]) == {(0, 0): "verbatim"}


# ---- quality rules ------------------------------------------------------------------


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    marked = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(marked),
    )


def test_quality_counts(spark, odd, none):
    texts = [made(WORDS[:4], i, 20 + i) + "\n" + "again and again\n" * (i % 3) for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for df in (docs, odd):
        for r in quality_rules.judge(df).collect():
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(r.text)
            assert r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words)
            assert not (r.kept and r.base_failed) and r.kept == (not r.base_failed and not r.broken)
    assert quality_rules.judge(none).collect() == []
    assert quality_rules.passing(odd).columns == odd.columns


def test_quality_verdicts(spark):
    good = " ".join(f"the word{i} of place{i}" for i in range(40))
    bad = {
        "symbols": " ".join(f"the*** word{i}$$$" for i in range(60)),
        "capitals": good.upper(),
        "stop_words": " ".join(f"word{i}" for i in range(90)),
        "repeated_lines": good + "\n" + "\n".join(["a b"] * 40 + ["c"]),
    }
    docs = spark.createDataFrame([("good", good), *bad.items()], "doc_id string, text string")
    found = {r.doc_id: r.broken for r in quality_rules.judge(docs).collect()}
    assert found["good"] == [] and all(name in found[name] for name in bad)


# ---- repeated strings ---------------------------------------------------------------


def spans_by_brute_force(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        marked = set()
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                marked.update(range(i, i + length))
        out.append((len(marked), bytes(b for i, b in enumerate(t) if i not in marked)))
    return out


@pytest.mark.parametrize("group", [4096, 1])
def test_repeated_strings(spark, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rng = random.Random(5)
    blocks = ["".join(rng.choice("abñ ") for _ in range(rng.randint(5, 60))) for _ in range(12)]
    texts = ["".join(rng.choice(blocks) for _ in range(rng.randint(0, 14))) for _ in range(40)]
    texts += ["a" * 300, "ab" * 100, "", texts[0], "a" * 39]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in suffix_dedup.without_repeats(docs, length=40, seed=11).collect()}
    for i, (removed, left) in enumerate(spans_by_brute_force([t.encode() for t in texts], 40)):
        assert (sum(s.end - s.start for s in found[i].spans), bytes(found[i].kept_bytes)) == (removed, left)


def test_repeated_strings_in_stretches(spark, monkeypatch, odd, none):
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefgh ") for _ in range(900))
    made_of = suffix_dedup.Runs(40, 11)
    whole = made_of(text)
    monkeypatch.setattr(suffix_dedup, "STRETCH", 64)
    parts = made_of(text)
    cover = lambda places: [p for v in places.tolist() for p in range(v >> 32, (v >> 32) + ((v >> 12) & 0xFFFFF))]
    assert cover(whole[2]) == cover(parts[2]) == list(range(861))
    found = suffix_dedup.without_repeats(odd).collect()
    left = {r.doc_id: bytes(r.kept_bytes) for r in found}
    assert len(found) == odd.count() and left[4] == left[5] == b"" == left[7] and left[6] == b"Same text."
    assert suffix_dedup.without_repeats(none).collect() == []


# ---- quality model ------------------------------------------------------------------


def test_quality_model_learns_and_scores(spark, odd, none):
    rows = []
    for i in range(600):
        good = i % 3 > 0
        text = made(WORDS, i, 60 + i % 50)
        rows.append((i, text if good else " ".join(w.upper() + "!!" for w in text.split()), int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int")
    known = quality_model.statistics(docs)
    model = quality_model.fit(known.where("doc_id % 5 > 0").select("x", "y", F.col("doc_id").alias("key")))
    tested = quality_model.scored(known.where("doc_id % 5 = 0"), model).collect()
    assert sum((r.score >= 0.5) == (r.y == 1) for r in tested) > 0.97 * len(tested)
    scores = [r.score for r in quality_model.scored(quality_model.statistics(odd.drop("score", "x")), model).collect()]
    assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    assert quality_model.scored(quality_model.statistics(none), model).collect() == []


def test_quality_model_without_both_labels(spark, none):
    empty = quality_model.statistics(none).select("x", F.lit(1).alias("y"), F.col("doc_id").alias("key"))
    assert quality_model.fit(empty) == 0.5
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    ones = quality_model.statistics(docs).select("x", F.lit(1).alias("y"), F.col("doc_id").alias("key"))
    assert quality_model.fit(ones) == 1.0


# ---- line dedup ---------------------------------------------------------------------


def lines_by_brute_force(texts, least):
    """Cut every line in a run of enough words that stands somewhere earlier, too."""
    cut = [[(n, line.strip(" \t\n\x0b\x0c\r")) for n, line in enumerate(t.split("\n"))] for t in texts]
    runs = [[(n, line) for n, line in lines if line] for lines in cut]
    first, gone = {}, []
    for lines in runs:
        dead = set()
        for a in range(len(lines)):
            words = 0
            for b in range(a, len(lines)):
                words += len(lines[b][1].split())
                if words >= least:
                    key = tuple(line for _, line in lines[a : b + 1])
                    if key in first:
                        dead.update(range(lines[a][0], lines[b][0] + 1))
                    else:
                        first[key] = True
        gone.append(dead)
    return gone


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(8)
    lines = [made(WORDS, i, rng.randint(1, 7)) for i in range(9)] + ["", "  "]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randint(1, 12))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in line_dedup.without_repeats(docs, least_words=8).collect()}
    for i, gone in enumerate(lines_by_brute_force(texts, 8)):
        assert set(found[i].removed) == gone
        assert found[i].text == "\n".join(x for n, x in enumerate(texts[i].split("\n")) if n not in gone)


def test_line_dedup_of_odd_rows(spark, odd, none):
    found = line_dedup.without_repeats(odd).collect()
    left = {r.doc_id: r.text for r in found}
    assert len(found) == odd.count()
    assert left[1] is None and left[2] == "" and left[4] and left[5] == "" and left[6] == "Same text."
    assert line_dedup.without_repeats(none).collect() == []
    cut = line_dedup.cut_texts(odd)
    assert cut.columns == odd.columns and {r.doc_id for r in cut.collect()} == {1, 2, 3, 4, 6, 7, 8, None}


# ---- URL lists ----------------------------------------------------------------------


def test_url_lists(spark):
    entries = spark.createDataFrame(
        [
            ("bad.example.com", "hosts", "add", "2024-01-10"), ("bad.example.com", "hosts", "remove", "2024-02-01"),
            ("BAD.example.com", "hosts", "add", "2024-03-01"), ("example.org", "domains", "add", "2024-01-01"),
            ("x.example.net/en", "paths", "add", "2024-01-01"), ("tie.example.com", "hosts", "add", "2024-01-05"),
            ("tie.example.com", "hosts", "remove", "2024-01-05"), (None, "hosts", "add", "2024-01-01"), ("y", "hosts", "add", None),
        ],
        "pattern string, list string, action string, dated string",
    )
    cases = [
        (1, "https://bad.example.com/a", "2024-01-09", ""), (2, "https://u@BAD.example.com:80", "2024-01-10", "hosts:bad.example.com"),
        (3, "http://bad.example.com", "2024-02-01", ""), (4, "http://bad.example.com", "2025-01-01", "hosts:bad.example.com"),
        (5, "http://deep.sub.example.org/", "2024-01-01", "domains:example.org"), (6, "http://notexample.org/", "2024-01-01", ""),
        (7, "http://x.example.net/en/page?q=1", "2024-05-01", "paths:x.example.net/en"), (8, "http://x.example.net/english", "2024-05-01", ""),
        (9, "http://tie.example.com/", "2024-01-06", ""), (10, None, "2024-01-01", ""), (11, "no url", "2024-01-01", ""), (12, "http://bad.example.com", None, ""),
        (4, "http://bad.example.com", "2025-01-01", "hosts:bad.example.com"),
    ]
    captures = spark.createDataFrame(cases, "page_id long, url string, fetched string, expected string").withColumns({"list": F.lit(1), "_hits": F.lit(2), "_hit": F.lit(3), "_url": F.lit(4)})
    found = url_lists.evaluate(captures, entries).collect()
    assert len(found) == len(cases)
    for r in found:
        assert ",".join(r.hits) == r.expected and r.blocked == bool(r.expected) and (r.list, r._hits, r._hit, r._url) == (1, 2, 3, 4)
    assert url_lists.evaluate(captures.limit(0), entries).collect() == []


def test_url_lists_within_a_day(spark):
    day = "2024-01-10"
    entries = spark.createDataFrame(
        [("a.example.com", "hosts", action, f"{day} {hour}:00:00") for action, hour in (("add", "08"), ("remove", "12"), ("add", "18"))],
        "pattern string, list string, action string, dated string",
    )
    captures = spark.createDataFrame([(h, "http://a.example.com", f"{day} {h:02}:00:00") for h in (7, 9, 12, 17, 18, 23)], "h int, url string, fetched string")
    assert {r.h for r in url_lists.evaluate(captures, entries).collect() if r.blocked} == {9, 18, 23}
    assert all(not r.blocked for r in url_lists.evaluate(captures, entries.limit(0)).collect())


# ---- chat ---------------------------------------------------------------------------


def test_chat_layouts(spark):
    two = [("user", "hi <|im_end|> <||x"), ("assistant", "<|im_start|>assistant\nyes 𝄞")]
    records = [
        ("messages", '{"messages":[{"content":"hi <|im_end|> <||x","role":"user"},{"role":"assistant","content":"<|im_start|>assistant\\nyes 𝄞"}]}', two),
        ("conversations", '{"conversations":[{"from":"user","value":"hi <|im_end|> <||x"},{"from":"assistant","value":"<|im_start|>assistant\\nyes 𝄞"}]}', two),
        ("prompt", '{"response":"<|im_start|>assistant\\nyes 𝄞","prompt":"hi <|im_end|> <||x"}', two),
        ("instruction_input", '{"instruction":"do","input":"this","output":"done"}', [("user", "do\n\nthis"), ("assistant", "done")]),
        ("instruction_input", '{"instruction":"do","input":null,"output":null}', [("user", "do"), ("assistant", "")]),
        ("no_messages", '{"messages":[]}', []),
        ("messages", '{"messages":[{"role":"a\\nb%0A","content":null},{"role":null,"content":"x"}]}', [("a\nb%0A", ""), ("", "x")]),
        (None, '{"other":1}', []), (None, "no json", []), (None, None, []),
    ]
    df = spark.createDataFrame([(i, r[1]) for i, r in enumerate(records)], "id int, record string").withColumn("layout", F.lit(0))
    out = chat.rendered(chat.turns_of(df)).withColumns(
        {"read": chat.read_back(F.col("formatted")), "learned": chat.learned_text(F.col("formatted"), F.col("loss_spans"))}
    )
    found = {r.id: r for r in out.collect()}
    for i, (layout, _, turns) in enumerate(records):
        assert found[i].layout == layout
        assert [(t.role, t.text) for t in found[i].read] == turns
        assert found[i].learned == "".join(text for role, text in turns if role == "assistant")
        assert found[i].formatted.count(chat.START) == found[i].formatted.count(chat.END) == len(turns)
    assert chat.rendered(chat.turns_of(df.limit(0))).collect() == []


def test_chat_long_texts_and_further_fields(spark):
    """Texts beyond the limit of the variant parser, and records with fields of no turn."""
    long_text = F.repeat(F.lit('x"\\n'), 5_250_000)
    rows = spark.range(1).select(
        F.explode(
            F.array(
                F.to_json(F.struct(long_text.alias("prompt"), F.lit("y").alias("response"), F.lit(3).alias("id"))),
                F.to_json(F.struct(F.array(F.struct(F.lit("user").alias("role"), long_text.alias("content"))).alias("messages"))),
            )
        ).alias("record")
    )
    told = chat.turns_of(rows).select("layout", F.size("turns").alias("n"), F.length(F.col("turns")[0]["text"]).alias("size"))
    assert sorted(told.collect()) == [("messages", 1, 21_000_000), ("prompt", 2, 21_000_000)]
    records = [
        ('{"prompt":"a","response":"b","id":1}', "prompt", [("user", "a"), ("assistant", "b")]),
        ('{"prompt":"a","response":"b","system":"s","meta":{"x":[1]}}', "system_prompt", [("system", "s"), ("user", "a"), ("assistant", "b")]),
        ('{"id":"c","messages":[{"role":"user","content":"q","n":1},{"role":"assistant","content":null}]}', "messages", [("user", "q"), ("assistant", "")]),
        ('{"messages":[],"id":2}', "no_messages", []),
        ('{"instruction":"do","input":"","output":"done","source":null}', "instruction_input", [("user", "do"), ("assistant", "done")]),
        ('{"messages":3}', None, []), ('[1]', None, []), ('{"messages":[{"role":"user"}]}', None, []),
    ]
    df = spark.createDataFrame([(i, r[0], i) for i, r in enumerate(records)], "id int, record string, v int")
    odd = df.withColumns({"_fields": F.lit(1), "_which": F.lit(2), "_v": F.lit(3), "_pieces": F.lit(4)})
    out = chat.rendered(chat.turns_of(odd))
    assert set(odd.columns) < set(out.columns)
    for r in out.collect():
        assert (r.layout, [(t.role, t.text) for t in r.turns]) == records[r.id][1:]
        assert (r.v, r._fields, r._which, r._v, r._pieces) == (r.id, 1, 2, 3, 4)
    assert chat.turns_of(odd.drop("record").withColumnRenamed("v", "x").withColumn("V", F.lit(records[0][0])), record="V").first().layout == "prompt"


# ---- near-duplicates ----------------------------------------------------------------


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(45)] + [(100, i) for i in range(101, 140)]
    edges += [(5, 5), (None, 3), (200, 201), (201, 200)] + [(i, i + 1) for i in range(300, 330)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in components.components(df).collect()}
    assert found == {x: find(x) for x in parent}
    assert components.components(df.limit(0)).collect() == []


def near_by_brute_force(texts, percent):
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    group = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(group[a], group[b])
            if group[a] != low or group[b] != low:
                group[a] = group[b] = low
                changed = True
    return {i: (len(sets[i]), group[i]) for i in ids}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_equal_brute_force(spark, percent):
    rng = random.Random(4)
    many = [f"w{i}" for i in range(400)]
    texts = []
    for g in range(12):
        words = [rng.choice(many) for _ in range(120)]
        for _ in range(6):
            own = list(words)
            for _ in range(rng.randint(0, 5)):
                own[rng.randrange(len(own))] = rng.choice(many)
            texts.append(" ".join(own))
    texts += ["one two", "One TWO", "", " ", texts[0], texts[0].upper()]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in minhash.near_duplicates(docs, percent=percent).collect()}
    for i, (size, group) in near_by_brute_force(rows, percent).items():
        assert (found[i].n_shingles, found[i].component_id, found[i].kept) == (size, group, i == group)


def test_near_duplicates_of_odd_rows(spark, odd, none):
    found = minhash.near_duplicates(odd, percent=85).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == odd.count() and by_id[5].component_id == 4 and not by_id[5].kept
    assert by_id[1].n_shingles == by_id[2].n_shingles == by_id[3].n_shingles == 0 and by_id[3].kept
    assert by_id[None].kept and by_id[None].component_id is None
    assert minhash.near_duplicates(none).collect() == []
    left = minhash.one_of_each(odd)
    assert left.columns == odd.columns and {r.doc_id for r in left.collect()} == {1, 2, 3, 4, 6, 7, 8, None}


def test_fresh_names(spark):
    df = spark.createDataFrame([(1, 2)], "_a int, _A_ int")
    assert fresh(df, "_a", "_b") == ["_a__", "_b"]


def test_digest_of_ids(spark):
    row = spark.createDataFrame([([1, 20],)], "ids array<int>").select(F.sha2(bpe.ids_text(F.col("ids")), 256).alias("d"))
    assert row.first().d == hashlib.sha256(b"1 20").hexdigest()
