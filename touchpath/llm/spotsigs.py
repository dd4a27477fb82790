"""Document fingerprints: SpotSigs.

Content words that follow a common word (an anchor) form a signature: the
anchor and the next :data:`CHAIN` words that are no anchors themselves.  A
document's fingerprint is the set of its signatures, as sorted 32-bit hashes;
likeness is the Jaccard coefficient of two sets.

Other languages, code and tables have few common words or none.  Where
:data:`STRETCH` words or more follow each other without an anchor, all chains of
``CHAIN + 1`` of them are signatures, too; that depends on these words alone, so
a near copy shares them whatever stands around them.  A text that still has no
signature has the chains of all its words, or, of fewer words than a chain, its
whole sequence.  So equal texts have equal fingerprints, and every text has one.

For a corpus-wide join, documents are partitioned by set length: two sets can be
alike only if their lengths differ by no more than the threshold allows, so each
length band meets itself and the next one alone.  Within a band, sets meet by
the rare signatures of a prefix; pairs are verified with early abandoning.

Defined results: null is an empty text; an empty text's only signature is that of
no words; texts that differ in case, punctuation or white space alone have equal
fingerprints; repeated rows are documents like others.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import stash

# --- fixed values: common words of English, French, German and Spanish ---------
ANCHORS = frozenset("the a an is was of and to in that le la les un une des est et der die das ein eine ist und el los las una es y en de".split())
#: Content words in a signature.
CHAIN = 2
#: Words without an anchor from which on all their chains are signatures.
STRETCH = 8
THRESHOLD = 0.8

#: Letters of scripts that put no spaces between words (Thai to Khmer, kana,
#: Han): each is a word.
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def _clean(word: str) -> str:
    return word if word.isalnum() else _EDGES.sub("", word)


def signatures(text: str | None, anchors: frozenset[str] = ANCHORS, chain: int = CHAIN) -> np.ndarray:
    """Sorted distinct 32-bit hashes of a text's signatures."""
    words = [w for w in map(_clean, _UNSPACED.sub(r" \1 ", (text or "").lower()).split()) if w]
    found: set[int] = set()
    content = [i for i, w in enumerate(words) if w not in anchors]
    spots = [i for i, w in enumerate(words) if w in anchors]
    after = 0  # first entry of ``content`` behind the anchor
    for i in spots:
        while after < len(content) and content[after] < i:
            after += 1
        if after + chain > len(content):
            break
        spot = " ".join([words[i], *[words[k] for k in content[after:after + chain]]])
        found.add(zlib.crc32(spot.encode("utf-8", "replace")))

    def chains(start: int, end: int) -> None:
        found.update(zlib.crc32(("~ " + " ".join(words[i:i + chain + 1])).encode("utf-8", "replace")) for i in range(start, end - chain))

    for i, j in zip([-1, *spots], [*spots, len(words)]):
        if j - i > STRETCH:
            chains(i + 1, j)
    if not found:
        chains(0, len(words))
    if not found:
        return np.array([zlib.crc32(("~ " + " ".join(words)).encode("utf-8", "replace"))], np.uint32)
    return np.sort(np.fromiter(found, np.uint32, len(found)))


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard of two sorted sets; 0 as soon as the lengths rule ``least`` out."""
    small, large = sorted((len(a), len(b)))
    if small < least * large:
        return 0.0
    if len(a) == len(b) and (a == b).all():
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    value = common / (len(a) + len(b) - common)
    return value if value >= least else 0.0


def written(spots: np.ndarray) -> str:
    return spots.astype(">u4").tobytes().hex()


# --- documents beside their successor ----------------------------------------

SUCCESSOR_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edit(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by the first as many code points
    of ``following`` (or all of it)."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def ranges(docs: DataFrame, rows_each: int) -> list[int]:
    """Cuts of doc_id into ranges of about ``rows_each`` rows (at most 10,000
    ranges)."""
    count = max(1, min(10_000, docs.count() // rows_each))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / count for i in range(1, count)], 10 * count)).first()[0] if count > 1 else []
    return sorted({int(c) for c in cuts or []})


def in_order(docs: DataFrame, rows_each: int = 2000) -> DataFrame:
    """``docs`` (doc_id, text) dealt into ranges of doc_id and sorted in each,
    with the first row of the next range behind it (``ghost``): so a task can
    see every row beside its successor while it holds two texts.  The last
    range is followed by the first.  Only the first rows' ids, one per range,
    pass the driver."""
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    cuts = ranges(keyed, rows_each)
    place = _range_of(F.col("doc_id"), cuts)
    ids = keyed.select("doc_id", place.alias("range"))
    firsts = sorted((r["range"], r["first"]) for r in ids.groupBy("range").agg(F.min("doc_id").alias("first")).collect())
    # the range before each one, in a circle
    previous = {firsts[k][1]: firsts[k - 1][0] for k in range(len(firsts))}
    before = _lookup(F.col("doc_id"), previous)
    ghosts = F.when(before.isNotNull(), F.array(F.struct(place.alias("range"), F.lit(False).alias("ghost")), F.struct(before.alias("range"), F.lit(True).alias("ghost"))))
    both = keyed.withColumn("at", F.explode(F.coalesce(ghosts, F.array(F.struct(place.alias("range"), F.lit(False).alias("ghost"))))))
    dealt = both.select("doc_id", "no_id", "text", "at.range", "at.ghost").repartitionById(len(cuts) + 1, F.col("range").cast("int"))
    return dealt.sortWithinPartitions("range", "ghost", "doc_id", "text")


def _range_of(value: Column, cuts: list[int]) -> Column:
    """Index of the range that holds ``value``, by binary search."""

    @F.pandas_udf("long")
    def find(v):
        import pandas as pd

        return pd.Series(np.searchsorted(np.array(cuts, np.int64), v.to_numpy(np.int64), "right"), dtype="int64")

    return find(value)


def _lookup(value: Column, table: dict[int, int]) -> Column:
    @F.pandas_udf("long")
    def get(v):
        return v.map(table).astype("Int64")

    return get(value)


def beside_next(docs: DataFrame, rows_each: int = 2000) -> DataFrame:
    """For each row of ``docs``: its fingerprint, that of its edited text, and
    its likeness to both the edited text and the next document."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row whose successor is to come
        for batch in batches:
            out = []
            cols = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                doc_id, no_id, text, place, ghost = (c[i].as_py() for c in cols)
                if held is not None and held[3] != place:
                    held = None
                spots = signatures(text)
                if held is not None:
                    out.append(_pair(held, text, spots))
                # of several first rows (one id repeated) the first ghost is the successor
                held = None if ghost else (doc_id, no_id, text, place, spots)
            yield _batch(out)

    return in_order(docs, rows_each).select("doc_id", "no_id", "text", "range", "ghost").mapInArrow(walk, SUCCESSOR_SCHEMA)


def _pair(held: tuple, following: str, next_spots: np.ndarray) -> tuple:
    doc_id, no_id, text, _, spots = held
    edited = edit(text, following)
    edited_spots = signatures(edited)
    return (None if no_id else doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), written(spots), written(edited_spots),
            likeness(spots, edited_spots), likeness(spots, next_spots))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [c.split()[0] for c in SUCCESSOR_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(7)], names=names)


# --- corpus-wide join -----------------------------------------------------------

def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, spots): the signature set of each row of ``docs``."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [signatures(t).astype(np.int64) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "spots"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(make, "doc_id long, spots array<long>")


def near_pairs(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(members, pairs) of likeness ``threshold`` or more.

    Rows with equal sets form one class, named by its least doc_id, or below 0 by
    the set's hash where no row has one: members (doc_id, class).  Pairs (a, b, likeness) are of classes, so copies are never
    expanded.  A class joins its length band and, if a shorter set could match,
    the band below; there it is looked up by the signatures that are rarest in
    the corpus (a prefix long enough that two matching sets share one)."""
    rows = stash(fingerprints(docs), "spots")
    unnamed = -2 - F.xxhash64("spots").bitwiseAND(F.lit((1 << 62) - 1))
    sets = rows.groupBy("spots").agg(F.min("doc_id").alias("class")).withColumn("class", F.coalesce("class", unnamed))
    members = rows.join(sets, "spots").select("doc_id", "class")
    sets = stash(sets, "classes")
    n = F.size("spots")
    # length bands: band k holds lengths from threshold**-k; a match is at most one band away
    band = F.floor(F.log(n.cast("double")) / F.log(F.lit(1 / threshold))).cast("int")
    wide = sets.select("class", "spots", n.alias("n"), band.alias("band"), F.explode("spots").alias("spot"))
    often = wide.groupBy("spot").agg(F.count(F.lit(1)).alias("df"))
    ranked = wide.select("class", "n", "band", "spot").join(often, "spot").groupBy("class", "n", "band").agg(F.array_sort(F.collect_list(F.struct("df", "spot"))).alias("by"))
    prefix = (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).cast("int")
    keys = ranked.select("class", "n", "band", F.explode(F.slice("by", F.lit(1), prefix)).alias("k")).select("class", "n", "band", F.col("k.spot").alias("spot"))
    left = keys.select("class", "n", "spot", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
    a, b = left.alias("a"), keys.alias("b")
    meet = (F.col("a.spot") == F.col("b.spot")) & (F.col("a.band") == F.col("b.band"))
    sized = (F.col("a.n") <= F.col("b.n")) & (F.col("a.n") >= F.col("b.n") * threshold - 1e-9)
    once = (F.col("a.n") < F.col("b.n")) | (F.col("a.class") < F.col("b.class"))
    found = a.join(b, meet & sized & once).select(F.col("a.class").alias("a"), F.col("b.class").alias("b")).distinct()
    full = found.join(sets.selectExpr("class AS a", "spots AS x"), "a").join(sets.selectExpr("class AS b", "spots AS y"), "b")
    common = F.size(F.array_intersect("x", "y"))
    like = common / (F.size("x") + F.size("y") - common)
    return members, full.select("a", "b", like.alias("likeness")).where(F.col("likeness") >= threshold)
