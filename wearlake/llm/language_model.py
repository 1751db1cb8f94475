"""Likelihood of texts under a unigram model of subwords, over all segmentations.

The pieces are those of an existing vocabulary file. Its scores are merge ranks; by Zipf's
law they give the first weights and the prior. The weights are then re-estimated on the
training texts: expected piece counts over all segmentations of every distinct word
(forward and backward in log space), times its count, added up by Spark. A word stands
for a blank and its characters; pieces never cross words, so the probability of a text is
the product over its words and its end, and the forward recursion runs once per distinct
word. Characters outside the vocabulary are spelled in bytes.

Words are counted over the whole corpus and joined back. The ``HOT_WORDS`` most frequent
ones are given to every task, a table of bounded size; all others are joined by a shuffle,
so busy words move nothing and rare ones are never left out.

A-Z count as a-z; blanks are the six ASCII ones. Defined results: null and empty texts are
an end alone. A row whose training flag is null trains. Rows that repeat an id are scored
and counted each by itself; without any training row the prior weights score, and every
count is nought. Other columns are handed on, those named like results replaced.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearlake.llm.common import fresh, kept, small_batches

HOT_WORDS = 100_000
ROUNDS = 3
# How many pieces the prior is worth, and the rank at which Zipf's law bends.
PRIOR_PIECES = 2000.0
ZIPF_OFFSET = 10.0
# A task writes its counts out when it holds this many words.
HELD_WORDS = 400_000
# Longer words are walked character by character instead of as a table of all pieces.
LONG_WORD = 256
SMOOTHING = 0.1
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
RESULTS = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


def word_list(text: str | None) -> list[bytes]:
    """Words of a text. bytes.lower and bytes.split know ASCII only, as wanted."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class _Table:
    """Ids of strings by a 64-bit hash of their characters."""

    def __init__(self, strings: dict[str, int]):
        found = sorted((self._hash(string), i) for string, i in strings.items())
        self.keys = np.array([h for h, _ in found], np.uint64)
        self.ids = np.array([i for _, i in found], np.int32)

    @staticmethod
    def _hash(string: str) -> int:
        total = 0
        for character in string:
            total = (total * int(_FACTOR) + ord(character) + 1) & 0xFFFFFFFFFFFFFFFF
        return total

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of hashed strings, -1 for those that are none."""
        if not len(self.keys):
            return np.full(hashes.shape, -1, np.int32)
        at = np.searchsorted(self.keys, hashes)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == hashes, self.ids[at], -1)


class Pieces:
    """A vocabulary's pieces with log weights.

    Pieces that begin a word and pieces inside one are apart; the last two places are
    the byte class and the end of a text.
    """

    def __init__(self, heads: dict[str, int], inners: dict[str, int], prior: np.ndarray, weights: np.ndarray | None = None):
        self.heads, self.inners, self.prior = heads, inners, prior
        self.head_table, self.inner_table = _Table(heads), _Table(inners)
        self.longest = max([1, *map(len, heads), *map(len, inners)])
        self.byte, self.end = len(prior) - 2, len(prior) - 1
        self.set(prior if weights is None else weights)

    def plain(self) -> tuple:
        """What makes an equal one, as plain values."""
        return self.heads, self.inners, self.prior, self.weights

    def set(self, weights: np.ndarray) -> None:
        self.weights = weights
        # One more place, of no weight, for substrings that are no piece.
        with np.errstate(divide="ignore"):
            self.log = np.append(np.log(weights), -np.inf)

    @classmethod
    def read(cls, path: str, offset: float = ZIPF_OFFSET) -> Pieces:
        """From a sentencepiece file; a score is a negative rank."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        heads, inners, ranks = {}, {}, []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or "▁" in piece[1:]:
                continue
            (heads if piece[0] == "▁" else inners)[piece.lstrip("▁")] = len(ranks)
            ranks.append(-model.get_score(i))
        order = np.argsort(np.argsort(ranks))
        weights = 1 / (offset + np.concatenate([order, [len(order), len(order)]]))
        return cls(heads, inners, weights / weights.sum())

    def edges(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of words of one length: pieces from the start, pieces inside, spelled characters.

        ``head[w, e]`` is the piece that begins the word and ends before place e;
        ``inner[w, s, k]`` the one of k+1 characters from s; -1 is none. ``spelled[w, s]``
        counts the bytes of a character that is no piece, else 0.
        """
        n, longest = len(words[0]), self.longest
        head = np.full((len(words), n + 1), -1, np.int32)
        inner = np.full((len(words), n, min(n, longest)), -1, np.int32)
        spelled = np.zeros((len(words), n), np.int32)
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), n)
        sums = np.zeros((len(words), n + 1), np.uint64)
        for i in range(n):
            sums[:, i + 1] = sums[:, i] * _FACTOR + (codes[:, i] + np.uint64(1))
        for e in range(min(n, longest) + 1):
            head[:, e] = self.head_table(sums[:, e])
        for k in range(1, inner.shape[2] + 1):
            power = np.uint64(pow(int(_FACTOR), k, 1 << 64))
            inner[:, : n - k + 1, k - 1] = self.inner_table(sums[:, k:] - sums[:, :-k] * power)
        if n:
            for w, s in zip(*np.nonzero(inner[:, :, 0] < 0)):
                spelled[w, s] = len(words[w][s].encode("utf-8", "surrogatepass"))
        return head, inner, spelled

    def _weights(self, inner: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        found = self.log[inner]
        byte = self.log[self.byte] - math.log(256)
        if found.shape[2]:
            found[:, :, 0] = np.where(spelled > 0, spelled * byte, found[:, :, 0])
        return found

    def forward(self, head: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """Log probability of all ways to each place."""
        alpha = self.log[head]
        count, n, width = edge.shape
        for e in range(1, n + 1):
            reach = min(e, width)
            # Edges of k characters into e start at e - k.
            ways = [alpha[:, e]] + [alpha[:, e - k] + edge[:, e - k, k - 1] for k in range(1, reach + 1)]
            alpha[:, e] = np.logaddexp.reduce(ways, axis=0)
        return alpha

    def backward(self, edge: np.ndarray) -> np.ndarray:
        count, n, width = edge.shape
        beta = np.full((count, n + 1), -np.inf)
        beta[:, n] = 0
        for s in range(n - 1, -1, -1):
            reach = min(n - s, width)
            ways = [edge[:, s, k - 1] + beta[:, s + k] for k in range(1, reach + 1)]
            beta[:, s] = np.logaddexp.reduce(ways, axis=0)
        return beta

    def _ways(self, word: str, e: int) -> Iterator[tuple[int, int, float]]:
        """Pieces inside a word that end before place e: characters, piece, log weight."""
        for k in range(1, min(e, self.longest) + 1):
            piece = self.inners.get(word[e - k : e], -1)
            if piece >= 0:
                yield k, piece, float(self.log[piece])
            elif k == 1:
                size = len(word[e - 1].encode("utf-8", "surrogatepass"))
                yield k, -size, size * (float(self.log[self.byte]) - math.log(256))

    def _walk(self, word: str) -> np.ndarray:
        alpha = np.full(len(word) + 1, -np.inf)
        for e in range(len(word) + 1):
            first = self.log[self.heads.get(word[:e], -1)] if e <= self.longest else -np.inf
            alpha[e] = np.logaddexp.reduce([first, *(alpha[e - k] + w for k, _, w in self._ways(word, e))])
        return alpha

    def _expect_long(self, word: str, times: float, into: np.ndarray) -> None:
        alpha = self._walk(word)
        # The share of each place that leads to the end, carried from right to left.
        share = np.zeros(len(word) + 1)
        share[-1] = times
        for e in range(len(word), -1, -1):
            for k, piece, weight in self._ways(word, e):
                part = share[e] * math.exp(alpha[e - k] + weight - alpha[e])
                share[e - k] += part
                if piece >= 0:
                    into[piece] += part
                else:
                    into[self.byte] -= part * piece
            head = self.heads.get(word[:e], -1) if e <= self.longest else -1
            if head >= 0:
                into[head] += share[e] * math.exp(self.log[head] - alpha[e])

    def likelihood(self, words: list[str]) -> np.ndarray:
        """Natural log of the marginal probability of words of one length."""
        if len(words[0]) > LONG_WORD:
            return np.array([self._walk(word)[-1] for word in words])
        head, inner, spelled = self.edges(words)
        return self.forward(head, self._weights(inner, spelled))[:, -1]

    def expect(self, words: list[str], times: np.ndarray, into: np.ndarray) -> None:
        """Add the expected piece counts of words of one length, each so many times."""
        if len(words[0]) > LONG_WORD:
            for word, n in zip(words, times):
                self._expect_long(word, float(n), into)
            return
        head, inner, spelled = self.edges(words)
        edge = self._weights(inner, spelled)
        alpha, beta = self.forward(head, edge), self.backward(edge)
        total = alpha[:, -1:]
        share = np.exp(self.log[head] + beta - total) * times[:, None]
        np.add.at(into, head[head >= 0], share[head >= 0])
        count, n, width = edge.shape
        for k in range(1, width + 1):
            part = alpha[:, : n - k + 1] + edge[:, : n - k + 1, k - 1] + beta[:, k:] - total
            share = np.exp(part) * times[:, None]
            ids = inner[:, : n - k + 1, k - 1]
            np.add.at(into, ids[ids >= 0], share[ids >= 0])
            if k == 1:
                into[self.byte] += (share * spelled).sum()


def _by_length(words: list[str], most: int = 2000) -> Iterator[np.ndarray]:
    """Places of words of one length, so many that their lattices stay small."""
    lengths = np.array([len(word) for word in words])
    order = np.argsort(lengths, kind="stable")
    for part in np.split(order, np.nonzero(np.diff(lengths[order]))[0] + 1):
        step = max(1, most // max(1, lengths[part[0]] // 16))
        for start in range(0, len(part), step):
            yield part[start : start + step]


def _gathered(batches: Iterator[pd.DataFrame], rows: int = 50_000) -> Iterator[pd.DataFrame]:
    """Batches joined to larger ones, so that words of each length come in numbers."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= rows:
            yield pd.concat(held, ignore_index=True)
            held = []
    if held:
        yield pd.concat(held, ignore_index=True)


def _decoded(words) -> list[str]:
    return [bytes(word).decode("utf-8", "surrogatepass") for word in words]


def word_counts(rows: DataFrame, text: str, training: str) -> DataFrame:
    """``word`` (bytes) and ``n``, its count in training rows, for all words of all rows."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()

        def told() -> pd.DataFrame:
            out = pd.DataFrame({"word": list(held.keys()), "n": list(held.values())})
            held.clear()
            return out.astype({"n": "int64"})

        for batch in batches:
            for value, train in zip(batch["text"], batch["train"]):
                if train:
                    held.update(word_list(value))
                else:
                    for word in word_list(value):
                        held.setdefault(word, 0)
            if len(held) > HELD_WORDS:
                yield told()
        yield told()

    chosen = rows.select(F.col(text).cast("string").alias("text"), F.col(training).alias("train"))
    parts = chosen.mapInPandas(counted, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _expected(words: DataFrame, pieces: Pieces) -> np.ndarray:
    shared = words.sparkSession.sparkContext.broadcast(pieces.plain())

    def expected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Pieces(*shared.value)
        into = np.zeros(len(own.prior))
        for batch in _gathered(batches):
            texts, times = _decoded(batch["word"]), batch["n"].to_numpy(float)
            for part in _by_length(texts):
                own.expect([texts[i] for i in part], times[part], into)
        used = np.nonzero(into)[0]
        yield pd.DataFrame({"piece": used, "n": into[used]})

    found = words.mapInPandas(expected, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).toPandas()
    into = np.zeros(len(pieces.prior))
    into[found["piece"].to_numpy(int)] = found["n"].to_numpy(float)
    return into


def learned(words: DataFrame, texts: int, pieces: Pieces, rounds: int = ROUNDS) -> Pieces:
    """``pieces`` with weights re-estimated on counted words and the ends of ``texts``."""
    known = words.where("n > 0")
    for _ in range(rounds):
        counts = _expected(known, pieces)
        counts[pieces.end] = texts
        weights = counts + PRIOR_PIECES * pieces.prior
        pieces.set(weights / weights.sum())
    return pieces


def _valued(words: DataFrame, pieces: Pieces, total: int, different: int) -> DataFrame:
    """``words`` with ``known``, log10 ``base`` and log10 ``model`` of one occurrence."""
    shared = words.sparkSession.sparkContext.broadcast(pieces.plain())

    def valued(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Pieces(*shared.value)
        for batch in _gathered(batches):
            texts, value = _decoded(batch["word"]), np.zeros(len(batch))
            for part in _by_length(texts):
                value[part] = own.likelihood([texts[i] for i in part])
            yield batch.assign(model=value / math.log(10))

    found = words.mapInPandas(valued, "word binary, n long, model double")
    return found.withColumns(
        {
            "known": (F.col("n") > 0).cast("int"),
            "base": F.log10((F.col("n") + SMOOTHING) / F.lit(total + SMOOTHING * (different + 1))),
        }
    )


def score(
    docs: DataFrame, vocabulary: str, training: str = "training", text: str = "text",
    hot_words: int = HOT_WORDS, rounds: int = ROUNDS,
) -> DataFrame:
    """``docs`` with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    ``vocabulary`` is the path of a sentencepiece file on the driver, ``training`` the
    column that tells the rows to learn from. The base is a smoothed model of words.
    """
    spark = docs.sparkSession
    small_batches(spark)
    (train,) = fresh(docs, "_train")
    marked = docs.withColumn(train, F.coalesce(F.col(training), F.lit(True)))
    counts = kept(word_counts(marked, text, train))
    texts = marked.where(train).count()
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    total, different = sums["n"] + texts, sums["v"] + (texts > 0)
    pieces = learned(counts, texts, Pieces.read(vocabulary), rounds)
    values = kept(_valued(counts, pieces, total, different))

    hot = values.orderBy(F.desc("n"), "word").limit(hot_words).toPandas()
    places = {bytes(word): i for i, word in enumerate(hot["word"])}
    # The last place is for words that are not hot: they add nothing here.
    table = np.vstack([hot[["known", "base", "model"]].to_numpy(float).reshape(-1, 3), np.zeros((1, 3))])
    shared = spark.sparkContext.broadcast((places, table))

    @F.pandas_udf("n long, known long, base double, model double, rare array<binary>")
    def summed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        places, table = shared.value
        get, none = places.get, len(places)
        for batch in batches:
            found = []
            for value in batch:
                parts = word_list(value)
                at = np.array([get(part, none) for part in parts], dtype=np.int64)
                known, base, model = table[at].sum(axis=0)
                rare = [parts[i] for i in np.nonzero(at == none)[0]]
                found.append((len(parts), int(known), float(base), float(model), rare))
            yield pd.DataFrame(found, columns=["n", "known", "base", "model", "rare"])

    # Rows are numbered once, in a written table, so that numbers never change.
    others = [c for c in docs.columns if c != text]
    own = kept(
        docs.select(
            F.struct(*others).alias("own"),
            F.monotonically_increasing_id().alias("row"),
            summed(F.col(text).cast("string")).alias("s"),
        ).select("own", "row", "s.*")
    )
    rare = own.select("row", F.explode("rare").alias("word"))
    added = (
        rare.join(values, "word")
        .groupBy("row")
        .agg(F.sum("known").alias("k"), F.sum("base").alias("b"), F.sum("model").alias("m"))
    )
    end_base = math.log10((texts + SMOOTHING) / (total + SMOOTHING * (different + 1)))
    end_model = float(pieces.log[pieces.end] / math.log(10))

    def plus(name: str, more: str, last: float) -> Column:
        return F.col(name) + F.coalesce(F.col(more), F.lit(0)) + F.lit(last)

    return own.join(added, "row", "left").select(
        *(F.col("own")[c].alias(c) for c in others if c not in RESULTS),
        (F.col("n") + 1).alias("n_tokens"),
        plus("known", "k", int(texts > 0)).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        plus("base", "b", end_base).alias("base_score"),
        plus("model", "m", end_model).alias("score"),
    )
