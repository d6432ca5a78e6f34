"""Toxicity of texts behind obfuscated spelling: a noisy-channel decoder, then a classifier on the restored text.

A character trigram model is counted over all documents.  Tokens that may be
obfuscated (signs or digits among or instead of letters, repeated or doubled
letters, separators between letters, letters spaced out) become lattices whose
arcs restore a letter, drop a repetition or drop a separator, and a Viterbi
search under the character model picks the reading.  Numbers of digits alone
stay numbers.  Words and word beginnings of the restored text carry
weights learned from labelled rows; a logistic regression on a text's
strongest weights, fitted on other labelled rows, gives the score.
"""

from __future__ import annotations

import math
import re
import unicodedata
import uuid
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import ship

# --- fixed values: what a sign may stand for ---
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "aeiou", "(": "c", "#": "h", "€": "e", "£": "l"}
HOMOGLYPHS = str.maketrans("авекмнорстухіјѕԁ", "abekmhopctyxijsd")
ZERO_WIDTH = dict.fromkeys(map(ord, "­​‌‍⁠﻿"))
# --- costs of the channel (natural logarithms) ---
RESTORED, KEPT_SIGN, ONE_OF_RUN, TWO_OF_RUN, ONE_OF_TWO, DROPPED, KEPT_GAP = -1.0, -4.0, -0.7, -1.2, -2.5, -0.2, -1.5

#: Character classes: 0 ends a word, a-z, Latin-1 letters from 0xDF, other letters, digits.
SIZE = 64
_OTHER, _DIGIT = 60, 61
_CLASS = {chr(c): 1 + c - 97 for c in range(97, 123)} | {chr(c): 27 + c - 0xDF for c in range(0xDF, 0x100)} | {
    str(d): _DIGIT for d in range(10)} | {"÷": 0}
_BULK = np.zeros(0x3000, np.int64)
for _c in range(len(_BULK)):
    _BULK[_c] = _CLASS.get(chr(_c), _OTHER if chr(_c).isalpha() else 0)

#: Parts that shares of labelled rows are counted in.
SHARES = 1 << 40
#: Characters that are counted at once.
BLOCK = 1 << 20

_SEPARATORS = " \t._-*/"
_UNIT, _GAP = r"(?:[^\W_]|[@$!|+(#€£])", r"[ \t._*/\-]{1,2}"
_SPACED = re.compile(rf"(?<!\w)(?:{_UNIT}{_GAP}){{2,}}{_UNIT}(?!\w)")
_DIGITS = re.compile(rf"\d(?:{_GAP}\d){{0,2}}")
_TWICE = re.compile(r"([^\W\d_])\1")
_DOUBLED = re.compile(r"(?:([^\s._*/\-])\1){3,}")
_RUN = re.compile(r"([^\W\d_])\1\1")
_INNER = re.compile(r"[^\W\d_][._*/\-]{1,2}[^\W\d_]")
_AFTER = ".,;:!?\"')]}"
_LATIN = re.compile("[a-z]")
_LETTER = re.compile(r"[^\W\d_]")
_SIGN = re.compile("[" + re.escape("".join(LEET)) + "]")
_WORD = re.compile(r"[^\W\d_]+")
#: Letters of a word's beginning that decide whether it is decoded.
STEM = 6
#: Signs and digits without a letter, but not a number.
_LETTERLESS = re.compile("(?=.*[^\\d._*/+-])[" + re.escape("".join(LEET) + "._*/-") + "]{3,}")


def char_class(c: str) -> int:
    found = _CLASS.get(c)
    return (_OTHER if c.isalpha() else 0) if found is None else found


@lru_cache(maxsize=1 << 12)
def _codes(out: str) -> tuple[int, ...]:
    return tuple(map(char_class, out))


def plain(text: str) -> str:
    """Lower case, with compatibility forms, invisible characters and look-alikes of other scripts resolved."""
    text = text.lower()
    if text.isascii():
        return text
    if any(c > "ɏ" for c in set(text)) or "­" in text:
        text = unicodedata.normalize("NFKC", text).translate(ZERO_WIDTH)
        text = re.sub(r"\w+", lambda m: m[0].translate(HOMOGLYPHS) if _LATIN.search(m[0]) else m[0], text)
    return text


class CharModel:
    """Character trigram model with interpolated bigram and unigram estimates."""

    def __init__(self, counts: np.ndarray) -> None:
        c3 = counts.reshape(SIZE, SIZE, SIZE).astype(np.float64)
        c2, c1 = c3.sum(0), c3.sum((0, 1))
        p1 = (c1 + 0.1) / (c1 + 0.1).sum()
        p2 = (c2 + 5 * p1) / (c2.sum(1, keepdims=True) + 5)
        p3 = (c3 + 5 * p2) / (c3.sum(2, keepdims=True) + 5)
        self.log = np.log(p3).astype(np.float32)

    def __reduce__(self):
        return _with_log, (self.log,)

    @cached_property
    def flat(self) -> list[float]:
        """The logarithms by (a * SIZE + b) * SIZE + c."""
        return self.log.astype(float).ravel().tolist()

    def decode(self, span: str) -> str:
        """The likeliest reading of an obfuscated span (lower case), in time linear in its length."""
        log, n, mask, codes_of = self.flat, len(span), SIZE * SIZE - 1, _codes
        at: list[dict | None] = [None] * (n + 1)  # by place: (score, path) of the best way to each pair of last classes
        at[0] = {0: (0.0, None)}
        for i, arcs in enumerate(_lattice(span)):
            states, at[i] = at[i], None
            if not states:
                continue
            if len(arcs) == 1:  # the character as it is
                j, out, _ = arcs[0]
                k = codes_of(out)[0]
                target = at[j]
                if target is None:
                    target = at[j] = {}
                for state, (s, path) in states.items():
                    state = state * SIZE + k
                    s += log[state]
                    state &= mask
                    if state not in target or s > target[state][0]:
                        target[state] = (s, (path, out))
                continue
            for j, out, cost in arcs:
                codes = codes_of(out)
                target = at[j]
                if target is None:
                    target = at[j] = {}
                for state, (s, path) in states.items():
                    s += cost
                    for k in codes:
                        state = state * SIZE + k
                        s += log[state]
                        state &= mask
                    if state not in target or s > target[state][0]:
                        target[state] = (s, (path, out) if out else path)
        best = max(at[n].items(), key=lambda e: e[1][0] + log[e[0] * SIZE])
        parts, path = [], best[1][1]
        while path is not None:
            path, out = path
            parts.append(out)
        return "".join(reversed(parts))

    def restore_token(self, token: str) -> str:
        """A token without white space, restored if it may be obfuscated."""
        core = token.rstrip(_AFTER)
        if core.isalpha() and not _TWICE.search(core):
            return token
        if _coded(core) or _LETTER.search(core) and (_TWICE.search(core) or _INNER.search(core)):
            return self.decode(core) + token[len(core):]
        return token

    def spaced(self, text: str) -> str:
        def read(m: re.Match) -> str:
            if _DIGITS.fullmatch(m[0]) or not any(c.isalnum() for c in m[0]):
                return m[0]
            return self.decode(m[0].translate(HOMOGLYPHS) if _LATIN.search(m[0]) else m[0])

        return _SPACED.sub(read, text)

    def restore(self, text: str) -> str:
        """The whole text in lower case with every obfuscated token restored."""
        return re.sub(r"\S+", lambda m: self.restore_token(m[0]), self.spaced(plain(text)))


def _coded(core: str) -> bool:
    """True if signs, digits or runs stand for letters."""
    return bool(_LETTERLESS.fullmatch(core) or _LETTER.search(core) and (_SIGN.search(core) or _RUN.search(core)))


def squeezed(word: str) -> str:
    """``word`` with every run of a letter as one."""
    return re.sub(r"(.)\1+", r"\1", word)


def _with_log(log: np.ndarray) -> CharModel:
    model = CharModel.__new__(CharModel)
    model.log = log
    return model


def _lattice(span: str) -> Iterator[list[tuple[int, str, float]]]:
    """(end, output, cost) of the arcs that begin at each place of a span."""
    n, stop, chained = len(span), 0, 0
    chains = _DOUBLED.finditer(span)  # pairs after pairs
    chain = next(chains, None)
    for i, c in enumerate(span):
        first = i >= stop
        if first:
            stop = i + 1
            while stop < n and span[stop] == c:
                stop += 1
        while chain is not None and chain.end() <= i:
            chain = next(chains, None)
        chained = chain is not None and chain.start() <= i
        read = LEET.get(c, "")
        arcs = [(i + 1, r, RESTORED) for r in read]
        if stop - i >= 3 and first:
            for r in read or c:
                arcs += [(stop, r, ONE_OF_RUN), (stop, r + r, TWO_OF_RUN)]
        elif stop - i == 2 and (read or c.isalpha()):
            arcs += [(stop, r, ONE_OF_RUN if chained else ONE_OF_TWO) for r in read or c]
        if c in _SEPARATORS:
            arcs += [(i + 1, "", DROPPED), (i + 1, " ", KEPT_GAP)]
        else:
            arcs.append((i + 1, c, KEPT_SIGN if read else 0.0))
        yield arcs


def _bulk_codes(text: str) -> np.ndarray:
    codes = np.frombuffer(f"  {text.lower()} ".encode("utf-32-le", "replace"), "<u4")
    k = _BULK[np.minimum(codes, len(_BULK) - 1)]
    return (k[:-2] * SIZE + k[1:-1]) * SIZE + k[2:]


def char_model(docs: DataFrame, text: str = "text") -> CharModel:
    """The character model of all texts: trigram counts summed over tasks, at most 64 ** 3 of them."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, size = np.zeros(SIZE ** 3, np.int64), [], 0

        def add() -> None:
            nonlocal size
            for block in ["  ".join(held)] if size < 2 * BLOCK else held:
                counts.__iadd__(np.bincount(_bulk_codes(block), minlength=SIZE ** 3))
            held.clear()
            size = 0

        for batch in batches:
            for t in batch.column(0):
                if t.is_valid:
                    whole = t.as_py()
                    held.extend(whole[at:at + BLOCK] for at in range(0, len(whole), BLOCK))
                    size += len(whole)
                if size >= BLOCK:
                    add()
            add()
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(counts[found], pa.int64())], ["code", "n"])

    rows = docs.select(F.col(text).cast("string")).mapInArrow(run, "code int, n bigint").groupBy("code").agg(
        F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SIZE ** 3, np.int64)
    counts[rows["code"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return CharModel(counts)


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings of three to six characters."""
    return [word + " ", *[word[:n] for n in range(3, min(6, len(word)) + 1)]]


class Scorer:
    """Score of a text from word weights and a logistic regression on the strongest of them."""

    #: Distinct tokens that a task remembers at most.
    REMEMBERED = 1 << 18

    def __init__(self, model: CharModel, weights: dict[str, float], fit: np.ndarray | None = None,
                 prior: float = 0.0) -> None:
        self.model, self.weights, self.fit, self.prior = model, weights, fit, prior
        self.known: dict[str, float] = {}
        self.heads = {f[:3] for f in weights}
        #: Beginnings of words with a weight, runs of a letter as one.
        self.stems = {squeezed(f.strip())[:STEM] for f in weights}

    def __reduce__(self):
        return _scorer, (self.model, self.weights, self.fit, self.prior, uuid.uuid4().hex)

    def _may(self, core: str) -> bool:
        """False if no reading by dropped separators and doubled letters can have a weight.

        Such readings change neither the letters nor their order, only runs of a
        letter: a word of one begins, squeezed, like the squeezed letters from a part of the token on.
        """
        if not _TWICE.search(core) and (core.isalpha() or not _INNER.search(core)):
            return False
        parts = [core] if core.isalpha() else _WORD.findall(core)
        letters, stems = squeezed("".join(parts)), self.stems
        at = 0
        for i, part in enumerate(parts):
            own = squeezed(part)
            if i and letters[at - 1:at] == own[:1]:  # one run with the end of the part before
                at -= 1
            for n in range(1, STEM + 1):
                if letters[at:at + n] in stems:
                    return True
            at += len(own)
        return False

    def _weigh(self, token: str) -> float:
        get, heads = self.weights.get, self.heads
        core = token.rstrip(_AFTER)
        if core.isalpha():
            words = [core]
            decoded = _TWICE.search(core) and (_RUN.search(core) or self._may(core))
        else:
            words = _WORD.findall(token)
            decoded = _coded(core) or self._may(core)
        if decoded:
            words += _WORD.findall(self.model.restore_token(token))
        found = 0.0
        for w in words:
            if (w[:3] if len(w) > 2 else f"{w} "[:3]) in heads:
                for f in features_of(w):
                    if (own := get(f, 0.0)) > found:
                        found = own
        return found

    def evidence(self, text: str | None) -> list[float]:
        """Largest and second weight of the text's distinct tokens, their strong hits, and hits a token."""
        known, tokens = self.known, self.model.spaced(plain(text or "")).split()
        own = set(tokens)
        new = own.difference(known)
        if new and len(known) + len(new) > self.REMEMBERED:
            known.clear()
            new = own
        for t in new:
            known[t] = self._weigh(t)
        found = [w for w in map(known.get, own) if w]
        first = max(found, default=0.0)
        strong = sorted(w for w in found if w > 3)
        second = strong[-2] if len(strong) > 1 else 0.0
        return [first, second, math.log1p(len(strong)), len(strong) / max(1, len(tokens)) ** 0.5]

    def score(self, text: str | None) -> float:
        if self.fit is None:
            return self.prior
        z = float(self.fit[0] + self.fit[1:] @ np.array(self.evidence(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


#: The scorer that this worker process had last, with what it remembers, for its next task.
_LAST: dict[str, Scorer] = {}


def _scorer(model: CharModel, weights: dict[str, float], fit: np.ndarray | None, prior: float, name: str) -> Scorer:
    if name not in _LAST:
        _LAST.clear()
        _LAST[name] = Scorer(model, weights, fit, prior)
    return _LAST[name]


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the rows that no label is learned from (null ids: false)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    x = np.hstack([np.ones((len(x), 1)), x])
    w, keep = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * (x.shape[1] - 1)) * len(x) / 100
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + keep + 1e-9 * np.eye(len(w)),
                               x.T @ (weight * (p - y)) + keep @ w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, model: CharModel, sample: int = 20_000, least: int = 3) -> Scorer:
    """A scorer learned from at most about ``sample`` labelled rows that are not held out, chosen by a hash of doc_id.

    A kind of label may fill half of the sample and what the other leaves.
    Three quarters of them give the weights: log-odds of each word or word
    beginning that at least ``least`` toxic texts hold and that favours them.
    The rest fit the logistic regression, each row for as many as it stands for.
    A doc_id with several labels counts as toxic if one says so; null labels do
    not count, and equal texts with equal labels count once.  With labels of one
    kind only, or none, every score is the share of toxic labels (0 without any).
    """
    ship(docs.sparkSession)
    known = (labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y")))
    n1, n0 = known.agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") != 1)).first()
    share1, share0 = (min(1.0, max(sample / 2, sample - other) / own) if own else 1.0 for own, other in ((n1, n0), (n0, n1)))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(SHARES))
    of = {1: max(1, int(share1 * SHARES)), 0: max(1, int(share0 * SHARES))}
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4)).cast("int")
    # about ``sample`` rows whatever the labels are, so that no text is shuffled to meet them
    chosen = F.broadcast(known.where(place < F.when(F.col("y") == 1, of[1]).otherwise(of[0])))
    rows = (docs.select("doc_id", F.col("text").cast("string").alias("text")).where(~held_out(F.col("doc_id")))
            .join(chosen, "doc_id").groupBy(F.xxhash64("text").alias("hash"), "y")
            .agg(F.min_by(F.struct(fold.alias("fold"), "text"), "doc_id").alias("own")).select("own.fold", "y", "own.text"))
    rows = materialize(rows, "labelled")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}
        for batch in batches:
            y, found = [], []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own: set[str] = set()
                for token in set(model.spaced(plain(text.as_py() or "")).split()):
                    if token not in known:
                        if len(known) >= Scorer.REMEMBERED:
                            known.clear()
                        known[token] = _WORD.findall(model.restore_token(token))
                    for w in known[token]:
                        own.update(features_of(w))
                found.extend(own)
                y.extend([label] * len(own))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(y, pa.int32())], ["f", "y"])

    first = rows.where("fold != 0")
    totals = first.groupBy("y").count().collect()
    n1 = sum(r["count"] for r in totals if r["y"] == 1)
    n0 = sum(r["count"] for r in totals if r["y"] != 1)
    prior = n1 / (n0 + n1) if n0 + n1 else 0.0
    if not n0 or not n1:
        return Scorer(model, {}, None, prior)
    counts = first.select("y", "text").mapInArrow(spell, "f string, y int").groupBy("f").agg(
        F.count_if(F.col("y") == 1).alias("c1"), F.count_if(F.col("y") != 1).alias("c0"))
    weight = F.log((F.col("c1") + 0.5) / (n1 + 1)) - F.log((F.col("c0") + 0.5) / (n0 + 1))
    weights = {r["f"]: r["w"] for r in counts.where(F.col("c1") >= least).withColumn("w", weight).where("w > 1").collect()}
    scorer = Scorer(model, weights)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [scorer.evidence(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["y", "x"])

    fitted = rows.where("fold = 0").select("y", "text").mapInArrow(weigh, "y int, x array<double>").collect()
    y = np.array([float(r["y"] == 1) for r in fitted])
    weight = np.where(y == 1, 1 / share1, 1 / share0)
    weight = weight / weight.mean() if len(y) else weight
    if not y.any() or y.all():
        return Scorer(model, weights, None, prior)
    return Scorer(model, weights, _logistic(np.array([r["x"] for r in fitted]), y, weight), prior)


def score_texts(docs: DataFrame, keys: list[str], scorer: Scorer, text: str = "text") -> DataFrame:
    """Key columns and score of every row (null texts score like empty ones)."""
    ship(docs.sparkSession)
    kept = docs.select(*keys, F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [scorer.score(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], [*keys, "score"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields[:-1])
    return kept.mapInArrow(run, schema + "score double")


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of documents; other columns are ignored."""
    scorer = train(docs, labels, char_model(docs), sample)
    return score_texts(docs, ["doc_id"], scorer).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """The documents, columns as they were, whose score is below ``threshold``."""
    scorer = train(docs, labels, char_model(docs), sample)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(t.as_py()) < threshold for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
