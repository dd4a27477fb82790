"""MinHash near-dedup by a multi-index Hamming join.

A text's set holds its distinct word shingles (A-Z lower-cased).  Its signature
is 32 MinHash values of 14 bits; the distance of two signatures is the number of
values that differ.  The signature is cut into 8 chunks of 4 values.  By
pigeonhole, signatures that differ in at most 15 values have a chunk with at
most one error, so each chunk is looked up under every choice of the value that
may be wrong: 32 keys a signature, and every pair within the distance shares one.
(A pair at similarity 0.8 misses all of them with probability 1e-6.)

Texts with equal sets form one class; only classes are joined.  Every pair that
shares a key is judged, whatever its signatures' distance: first by sizes and by
sketches of the whole sets (512 bits, each the parity of the shingles that fall on
it).  A shingle that one set lacks flips one bit, so sketches differ in at most as
many bits as the sets in shingles: this step drops no link.  What is left is
confirmed on full sets: 100 * intersection >= 80 * union.  A bucket of any size
yields a star to one hub, not all its pairs: classes that end in one component
need no more pairs.  Then members of one bucket that lie in different components
meet: pair by pair in a small bucket; in a large one block by block, where a task
counts all intersections of two blocks at once from the members' differences
from the hub, and only links leave it.  So components are exact.

Defined results: null and empty texts have an empty set, are linked with nothing
and form components of their own; a text with fewer words than a shingle has its
whole sequence as the one shingle; repeated rows are copies; a null doc_id ranks
below all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchpath.llm.common import boxed, components, join_groups, slices, stash, utf8, word_bounds, word_hashes
from touchpath.llm.texthash import Runs, mix
from touchpath.operators.membership import key_filter, possible_members

VALUES, CHUNK = 32, 4
#: Bits of a set's sketch.
SKETCH = 512
#: Least similarity in per cent.
PERCENT = 80
SHINGLE_WORDS = 5
#: Rounds of stars at most; they end when a round confirms few links.
STARS = 2
#: Members over which a bucket is large, and members in a block of one.
LARGE, BLOCK = 512, 512

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLOCK = 1 << 18
_SALT = mix(np.arange(1, VALUES + 1, dtype=_U) * _U(0xA0761D6478BD642F))


def shingle_sets(raw: np.ndarray, off: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text, text by text."""
    for i, j in slices(off, _BLOCK):
        part = _LOWER[raw[off[i]:off[j]]]
        at = off[i:j + 1] - off[i]
        starts, ends = word_bounds(part, at)
        if not len(starts):
            for _ in range(i, j):
                yield np.zeros(0, _U)
            continue
        words = Runs(word_hashes(part, starts, ends))
        first = np.searchsorted(starts, at)
        for a, b in zip(first[:-1], first[1:]):
            if a == b:
                yield np.zeros(0, _U)
            elif b - a < k:
                yield words.hash(np.array([a]), np.array([b]))
            else:
                yield np.unique(words.hash(np.arange(a, b - k + 1), np.arange(a + k, b + 1)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """32 values of 14 bits: the low bits of the least hash under each salt."""
    low = np.full(VALUES, np.iinfo(_U).max, _U)
    for at in range(0, len(shingles), 1 << 12):
        part = shingles[at:at + (1 << 12), None] ^ _SALT[None, :]
        with np.errstate(over="ignore"):
            part = part * _U(0x9FB21C651E98DF25)
        part ^= part >> _U(32)
        np.minimum(low, part.min(axis=0), out=low)
    return (mix(low) & _U(0x3FFF)).astype(np.uint16)


def chunk_keys(sig: np.ndarray) -> list[int]:
    """Keys of every chunk with each one of its values left out; key 4 * c + v
    is of chunk c without its value v."""
    parts = sig.reshape(-1, CHUNK).astype(_U)
    out = np.zeros((len(parts), CHUNK), _U)
    for skip in range(CHUNK):
        code = np.zeros(len(parts), _U)
        for v in range(CHUNK):
            if v != skip:
                code = (code << _U(16)) | parts[:, v]
        out[:, skip] = mix(code + (np.arange(len(parts), dtype=_U) * _U(CHUNK) + _U(skip + 1)) * _U(0xC2B2AE3D27D4EB4F))
    return out.reshape(-1).view(np.int64).tolist()


def sketch(shingles: np.ndarray) -> list[int]:
    """Parities of the set's shingles by the low bits of their hash, as longs."""
    bits = np.bincount((mix(shingles) & _U(SKETCH - 1)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64).tolist()


def unlike(x: str, y: str) -> Column:
    """Bits that differ between the sketches of two join sides: no more than the
    shingles that one of the two sets lacks."""
    return sum((F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(1, SKETCH // 64)), F.bit_count(F.col(x)[0].bitwiseXOR(F.col(y)[0])))


FEATURES = "doc_id long, text_hash long, n long, set_id binary, keys array<long>, sketch array<long>"


def features(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, text_hash, n, set_id, keys, sketch) of each row of ``docs`` (doc_id,
    text); set_id names the set (128 bits), null for an empty one."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, ids, keys, sketches = [], [], [], []
            for s in shingle_sets(*utf8(b.column(2)), k):
                n.append(len(s))
                ids.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                keys.append(chunk_keys(signature(s)) if len(s) else None)
                sketches.append(sketch(s) if len(s) else None)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(keys, longs), pa.array(sketches, longs)],
                                             names=["doc_id", "text_hash", "n", "set_id", "keys", "sketch"])

    return keyed(docs).mapInArrow(make, FEATURES)


def keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def full_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(node, shingles) of the classes ``wanted`` (node, doc_id, text_hash):
    the texts are read again, and only those of wanted classes are kept."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [s.view(np.int64) for s in shingle_sets(*utf8(b.column(1)), k)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    # one key for both columns, so that repeated rows meet without another exchange
    key = F.xxhash64("text_hash", F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull()).alias("_key")
    rows = keyed(docs).select("doc_id", "text_hash", "text", key)
    want = wanted.select("node", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), key)
    # most texts have no such class: they stay out of the exchange
    rows = possible_members(rows, ["_key"], key_filter(want, ["_key"]))
    hit = rows.join(want, "_key").where((F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    return hit.dropDuplicates(["_key", "node"]).select("node", "text").mapInArrow(make, "node long, shingles array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    x = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(x, "a").join(y, "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(common * 100 >= (F.size("x") + F.size("y") - common) * percent).select("a", "b")


def blocks_of(large: DataFrame) -> DataFrame:
    """Members of large buckets (hub, node, n, label) dealt into tasks: those of
    the hub's most frequent component need not meet each other, all other pairs
    do, in blocks of :data:`BLOCK` by :data:`BLOCK`."""
    per = large.groupBy("hub", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("hub").agg(
        F.max(F.struct("c", "label")).alias("top"), F.sum("c").alias("all"))
    blocks = lambda n: F.greatest(F.ceil(n / BLOCK), F.lit(1)).cast("int")
    per = per.select("hub", F.col("top.label").alias("top"), blocks(F.col("top.c")).alias("tops"), blocks(F.col("all") - F.col("top.c")).alias("others"))
    rows = large.join(per, "hub").withColumn("other", F.col("label") != F.col("top"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("other"), F.col("others")).otherwise(F.col("tops"))).cast("int")
    rows = rows.withColumn("own", own)
    of_others, of_tops = F.sequence(F.lit(0), F.col("others") - 1), F.sequence(F.lit(0), F.col("tops") - 1)
    among = F.transform(of_others, lambda j: F.struct(F.lit(0).alias("kind"), F.least("own", j).alias("i"), F.greatest("own", j).alias("j")))
    to_top = F.transform(of_tops, lambda j: F.struct(F.lit(1).alias("kind"), F.col("own").alias("i"), j.alias("j")))
    from_top = F.transform(of_others, lambda i: F.struct(F.lit(1).alias("kind"), i.alias("i"), F.col("own").alias("j")))
    return rows.select("hub", "node", "n", "label", "other", F.explode(F.when(F.col("other"), F.concat(among, to_top)).otherwise(from_top)).alias("task"))


def links_in_large(large: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between different components of large buckets (hub, node, n,
    label): enough of them to connect all that any link connects.

    A member is its difference from the hub: shingles that the hub lacks, and the
    hub's that it lacks.  Two members' intersection follows from what their
    differences share, which a task counts for a block of members at once by a
    product of incidence matrices; only confirmed links leave the task."""
    x = sets.select("node", F.col("shingles").alias("x"))
    h = sets.select(F.col("node").alias("hub"), F.col("shingles").alias("h"))
    apart = large.select("hub", "node").join(x, "node").join(h, "hub").select(
        "hub", "node", F.array_except("x", "h").alias("more"), F.array_except("h", "x").alias("less"), F.size("h").cast("long").alias("size"))
    rows = blocks_of(large).join(apart, ["hub", "node"])

    def confirm(pdf: pd.DataFrame) -> pd.DataFrame:
        k = len(pdf)
        node, label, n = (pdf[c].to_numpy(np.int64) for c in ("node", "label", "n"))
        # shingles that at least two members have more, or have less
        tokens = [np.concatenate(list(pdf[c])) if k else np.zeros(0, np.int64) for c in ("more", "less")]
        lengths = [np.array([len(v) for v in pdf[c]]) for c in ("more", "less")]
        query = np.flatnonzero(pdf["other"].to_numpy(bool))
        common = np.zeros((len(query), k), np.float32)
        for values, many in zip(tokens, lengths):
            owner = np.repeat(np.arange(k), many)
            _, column, count = np.unique(values, return_inverse=True, return_counts=True)
            useful = count[column] > 1
            _, column = np.unique(column[useful], return_inverse=True)
            owner = owner[useful]
            for at in range(0, int(column.max()) + 1 if len(column) else 0, 4096):
                here = (column >= at) & (column < at + 4096)
                incidence = np.zeros((k, min(4096, int(column.max()) + 1 - at)), np.float32)
                incidence[owner[here], column[here] - at] = 1
                common += incidence[query] @ incidence.T
        less = lengths[1]
        both = common + (pdf["size"].to_numpy(np.int64) - less)[None, :] - less[query][:, None]
        link = (both * 100 >= (n[query][:, None] + n[None, :] - both) * percent) & (label[query][:, None] != label[None, :])
        # components inside the block: the least member reachable
        i, j = np.nonzero(link)
        i = query[i]
        least = np.arange(k)
        while True:
            low = least.copy()
            np.minimum.at(low, i, least[j])
            np.minimum.at(low, j, least[i])
            low = low[low]
            if (low == least).all():
                break
            least = low
        own = np.flatnonzero(least != np.arange(k))
        return pd.DataFrame({"a": node[own], "b": node[least[own]]})

    return rows.groupBy("hub", "task").applyInPandas(confirm, "a long, b long")


def link_components(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, stays) of each row of
    ``docs``; of a component, the text with the least doc_id stays (of several
    such texts, the one with the least hash)."""
    rows = stash(features(docs, shingle_words), "features")
    low = F.lit(-(1 << 63))
    first = F.min(F.struct(F.coalesce("doc_id", low).alias("at"), F.col("doc_id").alias("doc_id"), F.col("text_hash").alias("text_hash")))
    classes = rows.where("set_id IS NOT NULL").groupBy("set_id").agg(first.alias("r"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("rows"))
    total = rows.where("set_id IS NOT NULL").count()
    classes = stash(classes.select("set_id", "r.at", "r.doc_id", "r.text_hash", "n", "keys", "sketch", "rows", F.monotonically_increasing_id().alias("node")), "classes", 4 * total, light=True)

    # buckets of at least two classes; a class weighs what its buckets hold
    keys = classes.select("node", "n", F.explode("keys").alias("key")).withColumn("members", F.count(F.lit(1)).over(W.partitionBy("key")))
    shared = stash(keys.where("members > 1"), "buckets", VALUES * total, light=True)
    size = shared.count()
    weight = shared.groupBy("node").agg(F.sum("members").alias("weight"))
    shared = stash(shared.join(weight, "node"), "buckets", size, light=True)
    sketches = stash(classes.select("node", "doc_id", "text_hash", "sketch").join(weight.select("node"), "node", "left_semi"), "sketches", 4 * min(size, total), light=True)
    sets = stash(full_sets(docs, sketches, shingle_words), "sets", 16 * min(size, total), light=True)

    def alike(x: str, y: str) -> Column:
        """What the sizes leave possible."""
        a, b = F.col(f"{x}.n"), F.col(f"{y}.n")
        return F.least(a, b) * 100 >= F.greatest(a, b) * percent

    def near(n: Column, m: Column, x: str, y: str) -> Column:
        """What the sketches leave possible: sets of n and m shingles that are linked
        differ in (n + m) * (100 - percent) / (100 + percent) of them at most."""
        return unlike(x, y) * (100 + percent) <= (n + m) * (100 - percent)

    def hubs(rank: Column) -> DataFrame:
        return shared.groupBy("key").agg(F.max(F.struct(rank.alias("rank"), "node", "n")).alias("hub")).select("key", "hub.*")

    def labelled(rows: DataFrame, label: DataFrame | None) -> DataFrame:
        if label is None:  # each class is still a component of its own
            return rows.withColumn("label", F.col("node"))
        return rows.join(label.withColumnRenamed("component", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))

    def untested(pairs: DataFrame, tested: DataFrame | None) -> DataFrame:
        return pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")

    def also(have: DataFrame | None, more: DataFrame) -> DataFrame:
        return more if have is None else have.unionByName(more)

    def fresh(pairs: DataFrame, tested: DataFrame | None) -> DataFrame:
        """Pairs (a, b, m: their shingles together) that were not tested yet, each once,
        as far as their sketches leave a link possible."""
        pairs = untested(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "m").distinct(), tested)
        side = lambda at, out: sketches.select(F.col("node").alias(at), F.col("sketch").alias(out))
        both = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").where(near(F.col("m"), F.lit(0), "x", "y"))
        return stash(both.select("a", "b"), "pairs", size)

    # stars: the first hub is the weightiest class, a text the others derive
    # from; later ones are drawn anew in each bucket
    links = tested = label = None
    for turn in range(STARS):
        at = labelled(shared, label)
        mixed = at.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
        x, y = at.join(mixed, "key").alias("x"), labelled(hubs(F.col("weight") if turn == 0 else F.xxhash64("node", "key", F.lit(turn))), label).alias("y")
        pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.label") != F.col("y.label")) & alike("x", "y"))
        pairs = fresh(pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), (F.col("x.n") + F.col("y.n")).alias("m")), tested)
        tries = pairs.count()
        found = stash(confirmed(pairs, sets, percent), "links", tries)
        links, tested = also(links, found), also(tested, pairs)
        label = components(links, "components", size)
        if found.count() * 4 < tries:
            break

    # what the stars left apart
    at = labelled(shared, label)
    per = at.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("key").agg(F.count(F.lit(1)).alias("labels")).where("labels > 1").select("key")
    at = stash(at.join(per, "key"), "apart", size)
    small = at.where(F.col("members") <= LARGE).join(sketches.select("node", "sketch"), "node")
    x, y = small.alias("x"), small.alias("y")
    on = (F.col("x.key") == F.col("y.key")) & (F.col("x.label") < F.col("y.label")) & alike("x", "y") & near(F.col("x.n"), F.col("y.n"), "x.sketch", "y.sketch")
    pairs = x.join(y, on).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    pairs = stash(untested(pairs, tested), "pairs", size)
    more, tries = [], pairs.count()
    if tries:
        more.append(stash(confirmed(pairs, sets, percent), "links", tries))
    large = at.where(F.col("members") > LARGE)
    if not large.isEmpty():
        hub = hubs(F.col("weight")).select("key", F.col("node").alias("hub"))
        large = stash(large.select("key", "node", "n", "label").join(hub, "key").select("hub", "node", "n", "label").distinct(), "large", size)
        more.append(stash(links_in_large(large, sets, percent), "links", size))
    more = [found for found in more if not found.isEmpty()]
    if more:  # else the components are those of the stars
        for found in more:
            links = also(links, found)
        label = components(links, "components", size)

    named = labelled(classes.select("set_id", "node", "at", F.col("text_hash").alias("least_hash"), "rows"), label).withColumnRenamed("label", "component")
    least = named.groupBy("component").agg(F.min(F.struct("at", "least_hash")).alias("least"))
    # several branches of the result read it: without a table, each repeats its plan,
    # and a plan's size is what the driver's memory follows
    ids = stash(named.select("component", "set_id", "rows").join(least, "component").select("set_id", "least", "rows"), "ids", 4 * total, light=True)
    full = join_groups(rows.where("set_id IS NOT NULL").select("doc_id", "text_hash", "n", "set_id"), ids, "set_id", "rows", total)
    at = F.col("least.at")
    full = full.select("doc_id", "text_hash", "n", F.when(at > low, at).alias("component_id"),
                       ((F.coalesce("doc_id", low) == at) & (F.col("text_hash") == F.col("least.least_hash"))).alias("stays"))
    none = rows.where("set_id IS NULL").select("doc_id", "text_hash", "n", F.col("doc_id").alias("component_id"), F.lit(True).alias("stays"))
    return full.unionByName(none).withColumnRenamed("n", "n_shingles")


def drop_near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` (any columns) with one text of each component; rows that repeat
    a doc_id and text stay once."""
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_id"), F.coalesce("text_hash", F.lit(0)).alias("_hash")]
    staying = link_components(docs.select("doc_id", "text"), shingle_words, percent).where("stays").select(*key).distinct()
    rows = boxed(docs).withColumn("doc_id", F.col("row.doc_id")).withColumn("text_hash", F.xxhash64(F.col("row.text").cast("string"))).select("row", *key)
    return rows.join(staying, ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"]).select("row.*")
