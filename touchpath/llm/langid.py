"""Language identification: averaged hashed subword embeddings, linear softmax.

A text's subwords are its 2-, 3- and 4-byte grams of lower-cased UTF-8 that hold
no word boundary inside (one may stand at either end).  Each gram is hashed to
an embedding; a text is the mean of its grams' embeddings over its whole
length, and a linear softmax scores the languages.  Embeddings and weights are
trained together by stochastic gradient descent in numpy on a bounded sample
of labelled rows (:data:`SAMPLE_ROWS` per language, plus a short excerpt of
each); a fifth of the sample is held back for the temperature and the
rejection threshold.  For prediction, embeddings times weights fold into one
score per gram and language, so a pass over the bytes is all it takes.

Defined results: ``und`` with score 0 for null, empty and letterless texts, and
for all texts if nothing was learned (no labelled row).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchpath.llm.common import boxed, small_batches, utf8

UNDETERMINED = "und"
#: Bits of a gram's hash.
BITS = 13
#: Distinct labelled texts per language that the model is fitted on, in
#: expectation (the bound of the sample; texts are chosen by their hash).
SAMPLE_ROWS = 400
EXCERPT_BYTES = 48
DIM, EPOCHS, RATE, BATCH = 16, 12, 2.0, 32
#: Share of rightly classified held-back texts that rejection may cost.
REJECT_SHARE = 0.0005

_BLOCK = 1 << 18

# ASCII: letters lower-cased, the rest a word boundary; other bytes stay
_FOLD = np.full(256, 0x20, np.uint8)
for _b in range(256):
    if 65 <= _b <= 90:
        _FOLD[_b] = _b + 32
    elif 97 <= _b <= 122 or _b >= 128:
        _FOLD[_b] = _b


def grams(raw: np.ndarray, ends: np.ndarray):
    """(valid, bucket) for 2-, 3- and 4-byte grams starting at each byte;
    ``ends``: bytes up to the end of the text that each byte belongs to."""
    b = _FOLD[raw]
    # capitals of the Latin-1 letters: U+00C0..U+00DE is C3 80..9E in UTF-8
    upper = np.zeros(len(b), bool)
    upper[1:] = (b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E)
    b = b + upper.astype(np.uint8) * 0x20
    wide = np.concatenate([b, np.full(3, 0x20, np.uint8)]).astype(np.uint32)
    n = len(b)
    code, gap = wide[:n].copy(), np.zeros(n, bool)
    for k in (2, 3, 4):
        nxt = wide[k - 1:k - 1 + n]
        if k > 2:
            gap = gap | (wide[k - 2:k - 2 + n] == 0x20)
        code = code | (nxt << np.uint32(8 * (k - 1)))
        valid = ~gap & (ends >= k)
        if k == 2:
            valid &= (wide[:n] != 0x20) | (nxt != 0x20)
        h = (code + np.uint32(k)) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA77)
        yield valid, (h >> np.uint32(32 - BITS)).astype(np.intp)


def _blocks(raw: np.ndarray, off: np.ndarray):
    """Blocks of bytes: (first byte, last byte, rows that they touch)."""
    for s in range(0, len(raw), _BLOCK):
        e = min(s + _BLOCK, len(raw))
        yield s, e, int(np.searchsorted(off, s, "right")) - 1, int(np.searchsorted(off, e, "left"))


def score_sums(raw: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the grams' rows of ``table`` and number of grams for each text,
    block by block (a text may span many blocks)."""
    sums, count = np.zeros((len(off) - 1, table.shape[1])), np.zeros(len(off) - 1)
    for s, e, i, j in _blocks(raw, off):
        more = raw[s:min(e + 3, len(raw))]
        at = np.clip(off[i:j + 1], s, e)
        ends = np.repeat(off[i + 1:j + 1], np.diff(at)) - np.arange(s, e)
        pad = len(more) - (e - s)
        ends = np.concatenate([ends, np.zeros(pad, np.int64)])
        rows = np.flatnonzero(np.diff(at))  # texts with bytes in this block
        first = at[rows] - s
        for valid, bucket in grams(more, ends):
            valid, bucket = valid[:e - s], bucket[:e - s]
            got = table[bucket] * valid[:, None]
            sums[i + rows] += np.add.reduceat(got, first, axis=0, dtype=np.float64)
            count[i + rows] += np.add.reduceat(valid, first, dtype=np.float64)
    return sums, count


def gram_counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of one text."""
    raw = np.frombuffer(text, np.uint8)
    total = np.zeros(1 << BITS, np.int64)
    for s in range(0, len(raw), _BLOCK):
        part = raw[s:s + _BLOCK + 3]
        left = len(raw) - s - np.arange(len(part))
        for valid, bucket in grams(part, left):
            keep = valid.copy()
            keep[_BLOCK:] = False
            total += np.bincount(bucket[keep], minlength=1 << BITS)
    at = np.flatnonzero(total)
    return at, total[at]


@dataclass
class Model:
    """Scores per gram and language, temperature and rejection threshold."""

    langs: list[str] = field(default_factory=list)
    table: np.ndarray = field(default_factory=lambda: np.zeros((1 << BITS, 0), np.float32))
    temperature: float = 1.0
    reject_below: float = 0.0

    def probabilities(self, sums: np.ndarray, count: np.ndarray) -> np.ndarray:
        z = sums / np.maximum(count, 1)[:, None] / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def train(lang_of: list[str], whole: np.ndarray, cols: np.ndarray, counts: np.ndarray, at: np.ndarray, seed: int = 7) -> Model:
    """Fit on examples: language, whole text (or excerpt), and the buckets and
    counts ``at[i]:at[i + 1]``; deterministic in the examples' order."""
    langs = sorted({x for x, n in zip(lang_of, np.diff(at)) if n})
    if not langs:
        return Model()
    rng = np.random.default_rng(seed)
    use = np.flatnonzero(np.diff(at) > 0)
    y = np.array([langs.index(lang_of[i]) if lang_of[i] in langs else 0 for i in range(len(lang_of))])
    total = np.add.reduceat(counts, at[use]) if len(use) else np.zeros(0)
    weight = (counts / np.repeat(total, np.diff(at)[use])).astype(np.float32)
    held = np.arange(len(use)) % 5 == 4 if len(use) >= 50 else np.zeros(len(use), bool)
    fit_ = use[~held]
    emb = rng.normal(0, 0.1, (1 << BITS, DIM))
    out = rng.normal(0, 0.1, (DIM, len(langs)))
    steps, done = EPOCHS * -(-len(fit_) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(fit_)
        for k in range(0, len(order), BATCH):
            batch = order[k:k + BATCH]
            rate = RATE * (1 - done / steps)
            done += 1
            c = np.concatenate([cols[at[i]:at[i + 1]] for i in batch])
            w = np.concatenate([weight[at[i]:at[i + 1]] for i in batch])
            many = at[batch + 1] - at[batch]
            rows = np.repeat(np.arange(len(batch)), many)
            first = np.cumsum(many) - many
            mean = np.add.reduceat(emb[c] * w[:, None], first, axis=0)
            z = mean @ out
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(batch)), y[batch]] -= 1
            back = p @ out.T
            out -= rate * mean.T @ p / len(batch)
            np.subtract.at(emb, c, rate * w[:, None] * back[rows] * 10)
    model = Model(langs, (emb @ out).astype(np.float32))
    check = use[held] if held.any() else fit_
    z = np.array([weight[at[i]:at[i + 1]] @ model.table[cols[at[i]:at[i + 1]]] for i in check])
    truth = y[check]

    # one more error than was seen, so that a sample without any is not taken
    # for certainty
    odd = 1 / (len(check) + 2)

    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(axis=1, keepdims=True)
        hit = s[np.arange(len(s)), truth]
        rest = (s.sum(axis=1) - hit) / max(1, len(langs) - 1)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - (1 - odd) * hit - odd * rest))

    model.temperature = float(min(np.geomspace(0.05, 20, 120), key=loss))
    top = model.probabilities(z, np.ones(len(z))).max(axis=1)
    right = (z.argmax(axis=1) == truth) & whole[check]
    if right.any():
        model.reject_below = float(min(0.4, np.quantile(top[right], REJECT_SHARE)))
    return model


def learns(doc_id: Column) -> Column:
    """Rows that a model may learn from; the others are held out."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) != 1


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Train on the labelled rows of ``docs`` (doc_id, text, lang) that may be
    learned from.  The sample: texts whose hash falls below ``sample_rows`` over
    the language's number of distinct texts, each distinct text once; so copies
    and null texts leave it as it is."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
                       learns(F.col("doc_id")).alias("ok")).where("ok AND lang IS NOT NULL AND text IS NOT NULL")
    # one row per language, as the model has one output per language
    per = {r["lang"]: r["n"] for r in rows.select("lang", F.xxhash64("text").alias("h")).distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not per:
        return Model()
    share = F.create_map(*[F.lit(x) for lang, n in per.items() for x in (lang, min(1.0, sample_rows / n))])
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = rows.where(place < share[F.col("lang")]).select("lang", "text", F.xxhash64("text").alias("h")).dropDuplicates(["lang", "h"])

    def features(batches):
        for batch in batches:
            out: list[tuple] = []
            for lang, text, h in zip(*(batch.column(i).to_pylist() for i in range(3))):
                raw = text.encode("utf-8", "replace")
                at = (h & 0xFFFFFFFF) % max(1, len(raw) - EXCERPT_BYTES)
                for whole, part in ((True, raw), (False, raw[at:at + EXCERPT_BYTES])):
                    cols, n = gram_counts(part)
                    out.append((lang, h, whole, cols.astype("<i4").tobytes(), n.astype("<i4").tobytes()))
            names = ["lang", "h", "whole", "cols", "n"]
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kinds[k]) for k in range(5)], names=names)

    got = picked.mapInArrow(features, "lang string, h long, whole boolean, cols binary, n binary").collect()
    got.sort(key=lambda r: (r["h"], r["lang"], r["whole"]))
    # a few large arrays: what training took goes back to the system
    at = np.cumsum([0, *(len(r["cols"]) // 4 for r in got)])
    cols, counts = (np.frombuffer(b"".join(r[c] for r in got), "<i4") for c in ("cols", "n"))
    lang_of, whole = [r["lang"] for r in got], np.array([r["whole"] for r in got], bool)
    del got
    return train(lang_of, whole, cols, counts, at)


def predictor(model: Model):
    """An Arrow UDF: text -> struct(lang, score), over whole texts."""

    def predict(text: pa.Array) -> pa.Array:
        raw, off = utf8(text)
        lang, score = [UNDETERMINED] * (len(off) - 1), np.zeros(len(off) - 1)
        if model.langs and len(off) > 1:
            sums, count = score_sums(raw, off, model.table)
            p = model.probabilities(sums, count)
            best = p.argmax(axis=1)
            lang = [model.langs[i] for i in best]
            score = p[np.arange(len(best)), best]
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["lang", "score"])

    return F.arrow_udf(predict, T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())]))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike("\\p{L}"), F.lit(False))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Add lang_pred, score and rejected to ``docs``; columns of these names
    are replaced."""
    rows = boxed(docs.drop("lang_pred", "score", "rejected"))
    text = F.col("row.text").cast("string")
    out = rows.select("row", predictor(model)(text).alias("guess"), has_letter(text).alias("letter"))
    out = out.select("row", "letter", F.when(F.col("letter"), F.col("guess.lang")).otherwise(UNDETERMINED).alias("lang_pred"),
                     F.when(F.col("letter"), F.col("guess.score")).otherwise(0.0).alias("score"))
    low = (F.col("score") < model.reject_below) if model.langs else F.lit(False)
    return out.select("row.*", "lang_pred", "score", (~F.col("letter") | low).alias("rejected"))
