"""SimHash near-duplicates through deletion-variant signatures.

*Fingerprints.*  One bit per position of a hash, set if over half of the text's
shingles (repeats included) have it set.  A fingerprint is one or more words of
64 bits; the first is of XXH64, the others of what a mixing function makes of it.

*Signatures.*  The bits are cut into few segments, ``max_bits // 2 + 1`` unless
told otherwise (and 2 at least): fingerprints within ``2 x segments - 1`` bits have a segment
that differs by at most one bit.  Each segment is indexed under its
one-wildcard variants, a variant being the segment less one bit.  Two segments
that differ by at most one bit share a variant, so an equality join on
(segment, wildcard, remaining bits) meets every such pair, and a verification
of the whole fingerprints (``max_bits``) removes the rest.  With ``max_bits``
beyond the guarantee, pairs between the two are found with high probability.

*Buckets.*  Only distinct fingerprints are indexed: copies meet no more.
Buckets are read as a sorted stream.  In a bucket of up to ``bucket_cap``
fingerprints all are compared; out go all links if they are few, else a least
spanning forest of them, not the pairs: whichever bits a later check asks
for, the forest connects what the links within so many bits connect.  Larger
buckets lose no pair either.  Where ``max_bits`` is
within the guarantee, their fingerprints go on to a second signature: the
bucket's own and, of each other segment, the variants less so many bits that
the guarantee stays (``_second_signatures``).  Where it is beyond, no second
signature is sure to keep the pairs: the bucket is cut into blocks, and every
block is compared with every other (``_block_pairs``).

*Similarity.*  Where texts are asked to be alike by their shingles, links
between fingerprints are candidates, and the sets of distinct shingles decide
(``similar``): shared over all, ``similarity`` at least.  Fingerprints find most
links, not all: texts may meet in no segment, differ by more than ``max_bits``,
or be left out of a forest.  What remains is found exactly
(``_remaining``): in any one order of all shingles, two sets of the similarity
have ``k`` shingles in common among the first ``n - ceil(similarity n) + k`` of each
(``k`` is about ``n / 25``: sets of chance meetings have fewer).
So every set is indexed under these, and sets that meet there so often, and are not in one
component yet, are compared.  The order is by hash, with shingles that are common in a
sample of texts last: what is sampled decides how full buckets are, never what is found.
Buckets that stay crowded hold drafts of one text, most too far from each other.  A pair that
meets in none but these has all its meetings there, so sets of too few are out; of the
others, all shingles are counted: what no other component has is shared with nobody, and a
set with too much of that is out as well (``_open_shingles``).  Masks of the others tell pairs
apart before they are written (``_masks_allow``).  A draft that may still be similar to
another one is mostly similar to the text that they come from, so few components are left.  Where there is no such text,
pairs grow with the square of a crowd: they are compared all the same, and those near the similarity are written.

*Components.*  Alternating large-star and small-star steps on the links between
fingerprints.  What a step knows of a node is written to the shared folder
before it meets the node's links, so that a node of very many links is split
over tasks, or its small table broadcast.

Defined cases.  Null or blank text has fingerprint zero and is linked like any
other.  Texts of fewer words than a shingle are one shingle; blank ones have the empty set and are alike.  Null identifiers
are kept; the component's identifier is the smallest that is not null (null if
there is none).  Repeated rows come back as often as they went in.  An empty
table gives an empty result.  Very long texts are hashed in blocks.  Extra
columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, map_arrow, meet, quoted, staged, table, tagged

SEED = 42
BUCKET_CAP = 1024
BLOCK = 1 << 20


def word_blocks(data: bytes, size: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of ``data`` in lists of about ``size`` bytes; no word is cut."""
    start = 0
    while start < len(data):
        end = start + size
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield data[start:end].split()
        start = end


def shingle_hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of the text's word shingles, in order, block by block."""
    n, tail = 0, []
    for part in word_blocks((text or "").encode("utf-8", "surrogatepass").lower()):
        part = tail + part
        if len(part) >= shingle:
            n += 1
            yield np.array([xxhash.xxh64_intdigest(b" ".join(part[i : i + shingle]), SEED) for i in range(len(part) - shingle + 1)], dtype=np.uint64)
        tail = part[max(0, len(part) - shingle + 1) :] if shingle > 1 else []
    if n == 0 and tail:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(tail), SEED)], dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = 3, words: int = 1, distinct: bool = False) -> list[int]:
    """SimHash of the text: ``words`` unsigned 64-bit numbers; of every shingle, or with ``distinct`` of each once."""
    blocks = shingle_hashes(text, shingle)
    if distinct:
        every = list(blocks)
        blocks = iter([np.unique(np.concatenate(every))] if every else [])
    return _majority(blocks, words)


def _majority(blocks: Iterator[np.ndarray], words: int) -> list[int]:
    """The bits that over half of the hashes have."""
    ones, total = np.zeros((words, 64), np.int64), 0
    for hashes in blocks:
        ones, total = ones + _ones(hashes, words), total + len(hashes)
    return [int.from_bytes(np.packbits(2 * o > total).tobytes(), "big") if total else 0 for o in ones]


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The hashes of the distinct shingles, sorted."""
    every = [np.unique(h) for h in shingle_hashes(text, shingle)]
    return np.unique(np.concatenate(every)) if every else np.empty(0, np.uint64)


def _ones(h: np.ndarray, words: int) -> np.ndarray:
    """How many of the hashes have each bit set; later words are of the hashes mixed (64-bit finaliser of MurmurHash3)."""
    out = []
    for k in range(words):
        x = h + np.uint64((k * 0x9E3779B97F4A7C15) & (2**64 - 1))
        if k:
            for shift, odd in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
                x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
            x ^= x >> np.uint64(33)
        out.append(np.unpackbits(x.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64))
    return np.stack(out)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, words: int = 1, distinct: bool = False) -> DataFrame:
    """id, f0, f1, ... (64 bits each, as longs), one row per input row."""
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    names = [f"f{k}" for k in range(words)]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle, words, distinct) for t in b.column(1)], dtype=np.uint64).reshape(-1, words).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(np.ascontiguousarray(fp[:, k])) for k in range(words))], ["id", *names])

    return map_arrow(rows, hashed, f"id {rows.schema['id'].dataType.simpleString()}, " + ", ".join(f"{x} long" for x in names))


def cut(words: int, segments: int, width: int | None = None) -> list[tuple[int, int, int]]:
    """(word, first bit, bits) of each segment; a segment lies within one word, and has at most ``width`` bits of it (the others are verified only)."""
    if segments % words or not 0 < segments // words <= 64:
        raise ValueError("segments must be a multiple of words")
    n = segments // words
    edges = [64 * k // n for k in range(n + 1)]
    return [(w, a, min(z - a, width or 64)) for w in range(words) for a, z in zip(edges, edges[1:], strict=False)]


def _mask(start: int, bits: int) -> int:
    return ((1 << bits) - 1) << start


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _rest(slot: Column, names: list[str], segments: list[tuple[int, int, int]]) -> Column:
    """The bits of a slot's segment but the slot's own."""
    masks = [[F.lit(_signed(_mask(a, n) & ~(1 << (a + i)))) if i < n else F.lit(0).cast("long") for i in range(64)] for _, a, n in segments]
    word = F.coalesce(*[F.when(slot < F.lit(64 * max(k + 1 for k, s in enumerate(segments) if s[0] == w)), F.col(name)) for w, name in enumerate(names)])
    return word.bitwiseAND(F.get(F.array(*[m for row in masks for m in row]), slot))


def _signatures(distinct: DataFrame, names: list[str], segments: list[tuple[int, int, int]]) -> DataFrame:
    """slot, rest, f0, ...: for each segment and bit of it, the segment's bits but that one.  slot: segment * 64 + bit.

    Dealt and sorted by (slot, rest).  ``rest`` follows from the other columns
    and is not sent with them.
    """
    slots = F.array(*[F.lit(64 * k + i) for k, (_, _, n) in enumerate(segments) for i in range(n)])
    rest = _rest(F.col("slot"), names, segments)
    dealt = distinct.select(F.explode(slots).alias("slot"), *names).repartition("slot", rest)
    return dealt.select(F.col("slot").cast("long").alias("slot"), rest.alias("rest"), *names).sortWithinPartitions("slot", "rest")


def _runs(batches: Iterator[pa.RecordBatch], n_keys: int, cap: int) -> Iterator[tuple[np.ndarray, bool]]:
    """A stream sorted by its first ``n_keys`` columns, as rows x columns arrays: whole runs of equal keys of up to ``cap`` rows (False), pieces of longer runs (True).

    No more than a batch and ``cap`` rows are held.
    """
    held, over = None, False
    for b in batches:
        if not b.num_rows:
            continue
        rows = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns])
        if held is not None:
            same = (rows[0, :n_keys] == held[-1, :n_keys]).all()
            if over:
                yield held, True
                over = bool(same)
            else:
                rows = np.vstack([held, rows])
        edges = [0, *(np.flatnonzero((rows[1:, :n_keys] != rows[:-1, :n_keys]).any(axis=1)) + 1).tolist()]
        if over and len(edges) > 1:  # the long run ends in this batch
            yield rows[: edges[1]], True
            rows, edges, over = rows[edges[1] :], [e - edges[1] for e in edges[1:]], False
        whole, held = rows[: edges[-1]], rows[edges[-1] :]
        if len(whole):
            sizes = np.diff(edges)
            if (sizes > cap).any():
                long = np.repeat(sizes > cap, sizes)
                yield whole[long], True
                whole = whole[~long]
            yield whole, False
        over = over or len(held) > cap
    if held is not None:
        yield held, over


#: A bucket's links go out whole while there are no more than so many for each of its fingerprints.
LINKS_EACH = 4


def _near(u: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links i < j of the fingerprints ``u`` (rows of unsigned words) within ``max_bits``: all, or a least spanning forest."""
    left, right, most = [], [], LINKS_EACH * len(u)
    for at in range(0, len(u), 256):
        d = np.zeros((min(256, len(u) - at), len(u) - at), np.int16)
        for w in range(u.shape[1]):
            d += np.bitwise_count(u[at : at + 256, w, None] ^ u[None, at:, w])
        i, j = np.nonzero(d <= max_bits)
        i, j = i[i < j] + at, j[i < j] + at
        left.append(i)
        right.append(j)
        most -= len(i)
        if most < 0:
            return _forest(u, max_bits)
    return np.concatenate(left), np.concatenate(right)


def _forest(u: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a least spanning forest: grown from any fingerprint by the nearest one outside, while it is within ``max_bits``."""
    far = np.int16(64 * u.shape[1] + 1)
    best, parent, out = np.full(len(u), far), np.full(len(u), -1), np.ones(len(u), bool)
    links = []
    for _ in range(len(u)):
        at = int(np.argmin(np.where(out, best, far + 1)))
        out[at] = False
        if best[at] <= max_bits:
            links.append((parent[at], at))
        d = np.bitwise_count(u ^ u[at]).sum(axis=1, dtype=np.int16)
        nearer = d < best
        best[nearer], parent[nearer] = d[nearer], at
    a = np.array(links, dtype=np.int64).reshape(-1, 2)
    return a[:, 0], a[:, 1]


#: Buckets of up to so many fingerprints are compared all at once, larger ones each for itself.
FEW = 8


def _linked(rows: np.ndarray, n_keys: int, max_bits: int) -> np.ndarray:
    """Links (a0.., b0..) within the runs of equal keys of ``rows``."""
    edges = np.concatenate([[0], np.flatnonzero((rows[1:, :n_keys] != rows[:-1, :n_keys]).any(axis=1)) + 1, [len(rows)]])
    sizes = np.diff(edges)
    fps = np.ascontiguousarray(rows[:, n_keys:]).view(np.uint64)
    out = []
    few = (sizes > 1) & (sizes <= FEW)
    held = np.repeat(few, sizes)
    u, run = fps[held], np.repeat(np.flatnonzero(few), sizes[few])
    for k in range(1, FEW):
        at = np.flatnonzero(run[:-k] == run[k:]) if len(run) > k else np.empty(0, int)
        if not len(at):
            break
        d = np.bitwise_count(u[at] ^ u[at + k]).sum(axis=1, dtype=np.int64)
        at = at[(d <= max_bits) & (d > 0)]
        out.append(np.hstack([u[at], u[at + k]]))
    for i in np.flatnonzero(sizes > FEW):
        u = np.unique(fps[edges[i] : edges[i + 1]], axis=0)
        a, b = _near(u, max_bits)
        out.append(np.hstack([u[a], u[b]]))
    return np.vstack(out).view(np.int64) if out else np.empty((0, 2 * fps.shape[1]), np.int64)


def _second_signatures(over: DataFrame, names: list[str], segments: list[tuple[int, int, int]], guarantee: int) -> DataFrame:
    """key, f0, ...: the bucket's signature with each variant of each other segment less ``guarantee // (segments - 1)`` bits.

    Outside the bucket's segment, fingerprints within the guarantee differ by
    at most ``guarantee`` bits, so that one of the other segments differs by
    no more than that share of it.  Keys are hashed; what meets is verified.
    """
    loose = guarantee // max(1, len(segments) - 1)
    masks = [np.array([_mask(a, n) & ~sum(1 << (a + i) for i in c) for c in combinations(range(n), min(loose, n))], dtype=np.uint64) for _, a, n in segments]

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns]):
                slot, rest, fp = int(row[0]), int(row[1]), row[2:]
                keys = []
                for k, (w, _, _) in enumerate(segments):
                    if k != slot // 64:
                        kept = (fp[w].view(np.uint64) & masks[k]).tolist()
                        keys += [xxhash.xxh64_intdigest(f"{slot}:{rest}:{k}:{m}:{x}") for m, x in enumerate(kept)]
                cols = [pa.array(np.array(keys, np.uint64).view(np.int64)), *(pa.array(np.full(len(keys), x, np.int64)) for x in fp)]
                yield pa.RecordBatch.from_arrays(cols, ["key", *names])

    return map_arrow(over, expand, "key long, " + ", ".join(f"{x} long" for x in names))


def _block_pairs(over: DataFrame, names: list[str], bucket_cap: int) -> DataFrame:
    """slot, rest, i, j, f0, ...: the fingerprints of buckets over the cap, once for each pair of blocks i < j that their block is in.

    A bucket has as many blocks of about ``bucket_cap`` as it takes, two at
    least, so that any two of its fingerprints meet under some pair.
    """
    sizes = staged(over.groupBy("slot", "rest").agg(F.ceil(F.count(F.lit(1)) / bucket_cap).cast("int").alias("blocks")), "simhash-blocks").withColumn("blocks", F.greatest("blocks", F.lit(2)))
    dealt = over.join(sizes, ["slot", "rest"]).withColumn("mine", F.pmod(F.xxhash64(*names), "blocks").cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: k != F.col("mine"))
    met = dealt.withColumn("other", F.explode(others))
    return met.select("slot", "rest", F.least("mine", "other").cast("long").alias("i"), F.greatest("mine", "other").cast("long").alias("j"), *names)


def links(distinct: DataFrame, names: list[str], max_bits: int = 2, n_segments: int | None = None, bucket_cap: int = BUCKET_CAP, width: int | None = None) -> DataFrame:
    """a0.., b0..: enough links between distinct fingerprints (columns ``names``) to connect what is within ``max_bits`` and meets."""
    if n_segments is None:  # two at least: a bucket that is too large is parted by another segment
        n_segments = max(2, max_bits // 2 + 1)
        n_segments += -n_segments % len(names)
    segments = cut(len(names), n_segments, width)
    guarantee = min(max_bits, 2 * n_segments - 1)
    ends = [f"a{k}" for k in range(len(names))] + [f"b{k}" for k in range(len(names))]

    def batch(rows: np.ndarray, columns: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, k])) for k in range(rows.shape[1])], columns)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links (slot -1), and the fingerprints of buckets over the cap (their b-columns hold nothing; a slot from 0)."""
        for rows, over in _runs(batches, 2, bucket_cap):
            if over:
                out = np.hstack([rows, np.zeros((len(rows), len(names)), np.int64)])
            else:
                found = _linked(rows, 2, max_bits)
                out = np.hstack([np.full((len(found), 1), -1), np.zeros((len(found), 1), np.int64), found])
            if len(out):
                yield batch(out, ["slot", "rest", *ends])

    def compare_all(n_keys: int):
        def compare_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, _ in _runs(batches, n_keys, 1 << 62):
                found = _linked(rows, n_keys, max_bits)
                if len(found):
                    yield batch(found, ends)

        return compare_runs

    longs = ", ".join(f"{x} long" for x in ends)
    found = staged(map_arrow(_signatures(distinct, names, segments), compare, "slot long, rest long, " + longs), "simhash-met")
    direct = found.where("slot < 0").select(*ends)
    over = found.where("slot >= 0").select("slot", "rest", *[F.col(f"a{k}").alias(n) for k, n in enumerate(names)])
    if not over.isEmpty():
        if max_bits > guarantee:
            keys, second = ["slot", "rest", "i", "j"], _block_pairs(over, names, bucket_cap)
        else:
            keys, second = ["key"], _second_signatures(over, names, segments, guarantee)
        second = second.repartition(*keys).sortWithinPartitions(*keys)
        direct = direct.unionByName(map_arrow(second, compare_all(len(keys)), longs))
    return direct.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for each node of the links, the smallest node that it is connected with."""
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    before = None
    while (state := mark(now)) != before and state[0]:
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "components-low")
        # large star: larger neighbours move to the smallest one
        large = staged(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "components-large")
        # small star: smaller neighbours, and the node itself, move to the smallest
        low = staged(large.groupBy("a").agg(F.min("b").alias("m")), "components-low")
        hop = large.join(low, "a").select("a", "b", "m")
        small = hop.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        now = staged(small.distinct(), "components")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def shingle_sets(ends: DataFrame, rows: DataFrame, tag: str, text_col: str, shingle: int) -> DataFrame:
    """tag, shingles (sorted hashes of the distinct ones, 8 bytes each) of the rows that ``ends`` (tag) names."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([shingle_set(t.as_py(), shingle).tobytes() for t in part.column(1)], pa.binary())], ["tag", "shingles"])

    texts = meet(rows.select(quoted(tag).alias("tag"), quoted(text_col).alias("text")), ends, "tag").select("tag", "text")
    return staged(map_arrow(texts, sets, f"tag {ends.schema['tag'].dataType.simpleString()}, shingles binary"), "simhash-sets")


def similar(pairs: DataFrame, made: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` (a, b, tag_a, tag_b) whose sets in ``made`` (tag, shingles) share ``similarity`` of all their shingles.

    They meet by two joins on the tag, between tables of which AQE splits what is hot.
    """
    kind = made.schema["tag"].dataType.simpleString()
    met = pairs.select("tag_a", "tag_b").join(made.select(F.col("tag").alias("tag_a"), F.col("shingles").alias("x")), "tag_a").join(made.select(F.col("tag").alias("tag_b"), F.col("shingles").alias("y")), "tag_b")

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(1), b.column(2), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True)) if min(len(x), len(y)) >= similarity * max(len(x), len(y)) else 0
                keep.append(shared >= similarity * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(keep, pa.bool_()))], ["pair"])

    pair = F.struct("tag_a", "tag_b").alias("pair")
    good = map_arrow(met.select(pair, "x", "y"), alike, f"pair struct<tag_a: {kind}, tag_b: {kind}>")
    return pairs.join(staged(good.select("pair.tag_a", "pair.tag_b"), "simhash-similar"), ["tag_a", "tag_b"])


def _classes(own: DataFrame, names: list[str], **index) -> DataFrame:
    """f0.., component_id: the distinct fingerprints of ``own`` (id, f0..) and the smallest id of each one's component."""
    first = F.struct(F.col("id").isNull().alias("no_id"), "id")
    distinct = staged(own.groupBy(*names).agg(F.min(first).alias("first")).select(*names, F.col("first.id").alias("first_id")), "simhash-distinct")
    # nodes are in the order of their identifiers, so that a component's root carries its identifier and nothing is grouped by component
    node = F.struct(F.col("first_id").isNull().alias("no_id"), F.col("first_id").alias("id"), *names)
    met = _ends(links(distinct, names, **index), distinct, names, node)
    roots = components(met).select(*[F.col("node")[n].alias(n) for n in names], F.col("root.id").alias("root_id"))
    return staged(distinct.join(roots, names, "left").select(*names, F.coalesce("root_id", "first_id").alias("component_id")), "simhash-classes")


def _ends(met: DataFrame, distinct: DataFrame, names: list[str], node: Column) -> DataFrame:
    """a, b: the links' ends (a0.., b0..) as nodes."""
    for end in "ab":
        met = met.join(distinct.select(*[F.col(n).alias(f"{end}{k}") for k, n in enumerate(names)], node.alias(f"node_{end}")), [f"{end}{k}" for k in range(len(names))])
    return met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


#: Of about so many texts, shingles that occur in ``COMMON`` or more are put last in the order, the ``MOST_COMMON`` most frequent of them.
SAMPLE, COMMON, MOST_COMMON = 8192, 3, 1 << 16


def _common(docs: DataFrame, tag: str, text_col: str, shingle: int, bucket_cap: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted hashes of common shingles, how many texts of a sample each is in, and how many parts of ``bucket_cap`` the fullest of their buckets may have."""
    rate = max(1, docs.count() // SAMPLE)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(t.as_py(), shingle).view(np.int64))], ["h"])

    texts = docs.where(F.pmod(F.xxhash64(quoted(tag)), F.lit(rate)) == 0).select(quoted(text_col).alias("text"))
    counts = map_arrow(texts, hashed, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= COMMON)
    found = counts.orderBy(F.desc("n"), "h").limit(MOST_COMMON).collect()
    h, n = np.array([r["h"] for r in found], np.int64).view(np.uint64), np.array([r["n"] for r in found], np.int64)
    by = np.argsort(h)
    return h[by], n[by], -(-int(n.max(initial=1)) * rate // bucket_cap)


def _shared(n: np.ndarray, similarity: float) -> np.ndarray:
    """How many shingles a set of ``n`` shares at least with one of the similarity."""
    return np.maximum(1, np.ceil(similarity * n - 1e-9)).astype(np.int64)


def _meetings(n: np.ndarray, similarity: float) -> np.ndarray:
    """How many of its first shingles a set of ``n`` shares at least with a set of the similarity that is not smaller."""
    return np.minimum(1 + n // 25, _shared(n, similarity))


def _shared_by(a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """How many shingles sets of ``a`` and ``b`` share at least, if they have the similarity."""
    return np.ceil(similarity / (1 + similarity) * (a + b) - 1e-6).astype(np.int64)


def _needed(a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """How many of their first shingles sets of ``a`` and ``b`` share at least, if they have the similarity.

    What they share up to where the first of the two lists ends is in both
    lists; beyond, it is no more than what is left of that list's set.
    """
    left = np.maximum(*[_shared(n, similarity) - _meetings(n, similarity) for n in (a, b)])
    return np.maximum(_meetings(np.minimum(a, b), similarity), _shared_by(a, b, similarity) - left)


def _first_shingles(shingles: np.ndarray, similarity: float, common: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """The first shingles in the order, as many as have the meetings with every set of the similarity; how many of them are not common."""
    at = np.searchsorted(common, shingles)
    hit = np.append(common, np.uint64(0))[at] == shingles if len(common) else np.zeros(len(shingles), bool)
    hit &= at < len(common)
    rare, often = shingles[~hit], shingles[hit][np.argsort(counts[at[hit]], kind="stable")]
    most = int(len(shingles) - _shared(len(shingles), similarity) + _meetings(len(shingles), similarity)) if len(shingles) else 0
    return np.concatenate([rare, often])[:most], min(len(rare), most)


def _sketches(docs: DataFrame, id_: Column, text_col: str, shingle: int, words: int, similarity: float, common: np.ndarray, counts: np.ndarray) -> DataFrame:
    """id, f0.. (fingerprint of the distinct shingles), d0, d1 (digest of their set), n (their number), first (the first ones in the order), rare (how many of these are not common)."""
    rows = docs.select(id_.alias("id"), quoted(text_col).alias("text"))
    names = [*(f"f{k}" for k in range(words)), "d0", "d1"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                longs, sizes, firsts, rare = [], [], [], []
                for t in b.column(1):
                    s = shingle_set(t.as_py(), shingle)
                    d = xxhash.xxh3_128_intdigest(s.tobytes())
                    longs.append([*_majority(iter([s] if len(s) else []), words), d >> 64, d & (2**64 - 1)])
                    first, r = _first_shingles(s, similarity, common, counts)
                    sizes.append(len(s))
                    firsts.append(first)
                    rare.append(r)
                wide = np.array(longs, dtype=np.uint64).reshape(-1, len(names)).view(np.int64)
                edges = np.cumsum([0, *map(len, firsts)])
                lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(np.concatenate([np.empty(0, np.uint64), *firsts]).view(np.int64)))
                cols = [b.column(0), *(pa.array(np.ascontiguousarray(wide[:, k])) for k in range(len(names))), pa.array(sizes, pa.int64()), lists, pa.array(rare, pa.int32())]
                yield pa.RecordBatch.from_arrays(cols, ["id", *names, "n", "first", "rare"])

    return map_arrow(rows, hashed, f"id {rows.schema['id'].dataType.simpleString()}, " + ", ".join(f"{x} long" for x in names) + ", n long, first array<long>, rare int")


# columns of a row of the index, after the bucket's keys; the last ones only where they are known: how many shingles the set has in common with other components, and from MASK on the mask of these
KEY, ROOT, SIZE, OPEN, MASK = range(5)

#: Bits of a mask, in words of 64; beyond about so many shingles a mask says little, and pairs are told apart by their meetings.
MASK_WORDS = 32
MASK_NAMES = [f"m{k}" for k in range(MASK_WORDS)]


def _may_share(a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether rows are of different components, of sizes that allow the similarity, and each with shingles enough that the other may have."""
    may = (np.minimum(a[..., SIZE], b[..., SIZE]) >= similarity * np.maximum(a[..., SIZE], b[..., SIZE]) - 1e-6) & (a[..., ROOT] != b[..., ROOT])
    return may if a.shape[-1] <= OPEN else may & (np.minimum(a[..., OPEN], b[..., OPEN]) >= _shared_by(a[..., SIZE], b[..., SIZE], similarity))


def _masks(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One row of words for each set of ``sizes`` tokens: the bits that its tokens fall on."""
    bits = np.zeros((len(sizes), 64 * MASK_WORDS), bool)
    bits[np.repeat(np.arange(len(sizes)), sizes), tokens & (64 * MASK_WORDS - 1)] = True
    return np.packbits(bits, axis=1).view(np.int64)


def _masks_allow(rows: np.ndarray, i: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
    """Which of the pairs i, j may be similar by their masks: a bit that only one of two sets has is of a shingle, at least, that the other does not have."""
    if rows.shape[1] <= MASK:
        return np.ones(len(i), bool)
    out = [np.empty(0, bool)]
    for at in range(0, len(i), 1 << 14):
        a, b = rows[i[at : at + (1 << 14)]], rows[j[at : at + (1 << 14)]]
        x, y = a[:, MASK:].view(np.uint64), b[:, MASK:].view(np.uint64)
        shared = np.minimum(*[u[:, OPEN] - np.bitwise_count(v & ~w).sum(axis=1, dtype=np.int64) for u, v, w in ((a, x, y), (b, y, x))])
        out.append(shared >= _shared_by(a[:, SIZE], b[:, SIZE], similarity))
    return np.concatenate(out)


def _across(rows: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows of a bucket that may be similar; ``rows`` are sorted by component."""
    ends, left, right = np.searchsorted(rows[:, ROOT], rows[:, ROOT], side="right"), [np.empty(0, int)], [np.empty(0, int)]
    for at in range(0, len(rows), 256):
        low = int(ends[at])
        if low == len(rows):
            break
        a, b = rows[at : at + 256, None], rows[None, low:]
        i, j = np.nonzero(_may_share(a, b, similarity) & (a[..., ROOT] < b[..., ROOT]))
        may = _masks_allow(rows, i + at, j + low, similarity)
        left.append(i[may] + at)
        right.append(j[may] + low)
    return np.concatenate(left), np.concatenate(right)


def _nearest(rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of the pairs i, j, for each component the one of the most equal sizes, the same in other buckets of the same sets: places in ``i``."""
    both, at = np.concatenate([rows[i, ROOT], rows[j, ROOT]]), np.tile(np.arange(len(i)), 2)
    order = np.lexsort([(rows[i, KEY] ^ rows[j, KEY])[at], np.abs(rows[i, SIZE] - rows[j, SIZE])[at], both])
    return np.unique(at[order][np.unique(both[order], return_index=True)[1]])


def _index_pairs(rows: np.ndarray, n_keys: int, similarity: float, every: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Meetings (key, key, how many the pair needs) within the runs of equal bucket keys; of crowded buckets, each component's nearest pair, and the rows.

    A bucket is crowded if it has over ``LINKS_EACH`` pairs for each row; with ``every`` none is.
    """
    edges = np.concatenate([[0], np.flatnonzero((rows[1:, :n_keys] != rows[:-1, :n_keys]).any(axis=1)) + 1, [len(rows)]])
    sizes = np.diff(edges)
    few = (sizes > 1) & (sizes <= FEW)
    u, run = rows[np.repeat(few, sizes), n_keys:], np.repeat(np.flatnonzero(few), sizes[few])
    none = np.empty((0, 3), np.int64)
    pairs, near, crowded = [none], [none], [rows[:0]]

    def met(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        need = _needed(a[:, SIZE], b[:, SIZE], similarity) if every else _meetings(np.minimum(a[:, SIZE], b[:, SIZE]), similarity)
        return np.column_stack([np.minimum(a[:, KEY], b[:, KEY]), np.maximum(a[:, KEY], b[:, KEY]), need])

    for k in range(1, FEW):
        at = np.flatnonzero(run[:-k] == run[k:]) if len(run) > k else np.empty(0, int)
        if not len(at):
            break
        at = at[_may_share(u[at], u[at + k], similarity)]
        at = at[_masks_allow(u, at, at + k, similarity)]
        pairs.append(met(u[at], u[at + k]))
    for r in np.flatnonzero(sizes > FEW):
        own = rows[edges[r] : edges[r + 1]]
        own = own[np.argsort(own[:, n_keys + ROOT], kind="stable")]
        bucket = own[:, n_keys:]
        i, j = _across(bucket, similarity)
        if not every and len(i) > LINKS_EACH * len(own):
            crowded.append(own)
            at = _nearest(bucket, i, j)
            near.append(met(bucket[i[at]], bucket[j[at]]))
        else:
            pairs.append(met(bucket[i], bucket[j]))
    return np.vstack(pairs), np.vstack(near), np.vstack(crowded)


def _open_shingles(own: DataFrame, similarity: float) -> DataFrame:
    """key, root, n, open, first, m0..: of the sets ``own`` (key, root, shingles) that can be similar to one of another component, the first shingles in an order made for them, and a mask of those in common.

    A shingle that no other component has is shared with no set that is looked
    for, so a set is out that has too few others (``open`` counts them).  The
    order is by how many sets have a shingle, with those of one component
    first: these fill the lists, and the buckets that are left are the smallest.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                sets = [np.frombuffer(v.as_buffer(), dtype=np.int64) for v in b.column(2)]
                sizes = np.array([len(x) for x in sets])
                cols = [np.concatenate(sets), *(np.repeat(c.to_numpy(), sizes) for c in (b.column(0), b.column(1))), np.repeat(sizes, sizes)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["token", "key", "root", "n"])

    rows = staged(map_arrow(own.select("key", "root", "shingles"), spread, "token long, key long, root long, n long"), "simhash-tokens")
    seen = rows.groupBy("token").agg(F.count(F.lit(1)).alias("sets"), (F.min("root") < F.max("root")).alias("several"))
    seen = staged(seen.where("several").select("token", "sets"), "simhash-several")
    lists = rows.join(seen, "token").groupBy("key", "root", "n").agg(F.array_sort(F.collect_list(F.struct("sets", "token"))).alias("shingles"))
    least = _shared_column(F.col("n"), similarity)
    lists = lists.withColumn("open", F.size("shingles").cast("long")).where(F.col("open") >= least)
    # of the first n - least + meetings, those that are not open come before
    most = (F.col("open") - least + _meetings_column(F.col("n"), similarity)).alias("most")
    names = ["key", "root", "n", "open"]

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                tokens, ends = b.column(4).flatten().to_numpy(), b.column(3).to_numpy().cumsum()
                sizes, most = b.column(3).to_numpy(), np.minimum(b.column(5).to_numpy(), b.column(3).to_numpy())
                first = tokens[np.arange(len(tokens)) < np.repeat(ends - sizes + most, sizes)]
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, most.cumsum()), pa.int32()), pa.array(first))
                masks = _masks(tokens, sizes)
                yield pa.RecordBatch.from_arrays([*b.columns[:4], lists, *(pa.array(np.ascontiguousarray(masks[:, k])) for k in range(MASK_WORDS))], [*names, "first", *MASK_NAMES])

    lists = lists.select(*names, F.col("shingles.token").alias("tokens"), most)
    return map_arrow(lists, masked, ", ".join(f"{x} long" for x in names) + ", first array<long>, " + ", ".join(f"{x} long" for x in MASK_NAMES))


def _shared_column(n: Column, similarity: float) -> Column:
    """As ``_shared``."""
    return F.greatest(F.lit(1), F.ceil(F.lit(similarity) * n - 1e-9).cast("long"))


def _meetings_column(n: Column, similarity: float) -> Column:
    """As ``_meetings``."""
    return F.least(1 + F.floor(n / 25), _shared_column(n, similarity))


def _crowd_meetings(own: DataFrame, similarity: float, bucket_cap: int) -> DataFrame:
    """ka, kb, need: where two of the sets ``own`` (key, root, shingles) meet under first shingles and may be similar, and how often they do if they are.

    Whether they may is asked before a meeting is written: by their sizes, by
    how many shingles they have in common with other components, and by the
    masks of these.  So what goes out is mostly similar; compared in memory are
    all that meet, which still grows with the square of a bucket.
    """

    def compare_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in _runs(batches, 3, 1 << 62):
            pairs = _index_pairs(rows, 3, similarity, True)[0]
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, k])) for k in range(3)], ["ka", "kb", "need"])

    lists = staged(_open_shingles(own, similarity), "simhash-open")
    rows = lists.select(F.explode("first").alias("token"), "key", "root", "n", "open")
    sizes = rows.groupBy("token").agg(F.greatest(F.ceil(F.count(F.lit(1)) / bucket_cap).cast("int"), F.lit(2)).alias("blocks"), (F.min("root") < F.max("root")).alias("several"))
    sizes = staged(sizes.where("several").select("token", "blocks"), "simhash-blocks")
    mine = rows.join(sizes, "token").withColumn("mine", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
    met = mine.withColumn("other", F.explode(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: k != F.col("mine"))))
    met = met.select("token", F.least("mine", "other").cast("long").alias("i"), F.greatest("mine", "other").cast("long").alias("j"), "key", "root", "n", "open")
    met = met.join(lists.select("key", *MASK_NAMES), "key").select("token", "i", "j", "key", "root", "n", "open", *MASK_NAMES)
    return map_arrow(met.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j"), compare_all, "ka long, kb long, need long")


def _remaining(own: DataFrame, classes: DataFrame, join: Callable[..., DataFrame], sets_of: Callable[[DataFrame], DataFrame], similarity: float, bucket_cap: int, parts: int) -> DataFrame:
    """``classes`` with all links that are left, found by the sets' first shingles.

    First what meets often enough in buckets that are not crowded, and the nearest
    pairs of crowded ones, which join most of what is left.  Pairs that meet in
    both kinds of buckets are compared if they may meet often enough in both.
    The others meet in crowded buckets only, so each set of a pair is in as many as the
    similarity demands.  These sets are looked at whole (``_open_shingles``): what is
    left of them is indexed anew and compared by blocks.  Buckets of common
    shingles, where one may go over the cap, are dealt in ``parts`` and count as crowded.
    """
    names = ["token", "part", "key", "root", "n"]
    rows = own.join(classes.select("d0", "d1", F.col("node.id").alias("of"), F.col("root.d0").alias("root")), ["d0", "d1"]).where(F.col("id") == F.col("of"))
    rows = rows.select(F.posexplode("first").alias("place", "token"), F.col("d0").alias("key"), "root", "n", "rare")
    part = F.when((F.lit(parts) > 1) & (F.col("place") >= F.col("rare")), F.pmod("key", F.lit(parts)) + 1).otherwise(0)
    dealt = rows.select("token", part.cast("long").alias("part"), "key", "root", "n").repartition("token", "part").sortWithinPartitions("token", "part")

    def batch(rows: np.ndarray, columns: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, k])) for k in range(rows.shape[1])], columns)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Meetings (part -1; of nearest pairs -2; key, root and n hold keys and need), and the rows of crowded buckets."""
        for rows, over in _runs(batches, 2, bucket_cap):
            for piece in (rows[at : at + bucket_cap] for at in range(0, len(rows), bucket_cap)) if over else (rows,):
                pairs, near, crowded = _index_pairs(piece, 2, similarity, False)
                whole = np.ones(len(piece), bool) if over else piece[:, 1] > 0
                if whole.any():  # these buckets go on elsewhere, so all their rows do
                    near = np.vstack([near, pairs]) if over else near
                    pairs = pairs[:0] if over else pairs
                    crowded = np.vstack([crowded[crowded[:, 1] == 0] if not over else crowded[:0], piece[whole]])
                kinds = [np.hstack([np.zeros((len(x), 1), np.int64), np.full((len(x), 1), k), x]) for k, x in ((-1, pairs), (-2, near))]
                out = np.vstack([*kinds, crowded])
                if len(out):
                    yield batch(out, names)

    found = staged(map_arrow(dealt, compare, ", ".join(f"{x} long" for x in names)), "simhash-index")
    pair = [F.col("key").alias("ka"), F.col("root").alias("kb"), F.col("n").alias("need")]
    often = lambda met: met.groupBy("ka", "kb", "need").agg(F.count(F.lit(1)).alias("met"))
    classes = join(classes, often(found.where("part < 0").select(*pair)).where("met >= need").select("ka", "kb"))
    crowded = found.where("part >= 0").select("token", "key", "n")
    if crowded.isEmpty():
        return classes
    now = staged(crowded.join(classes.select(F.col("d0").alias("key"), F.col("root.d0").alias("root")), "key"), "simhash-crowded")
    apart = staged(now.groupBy("token").agg((F.min("root") < F.max("root")).alias("several")).where("several").select("token"), "simhash-apart")
    seen = staged(now.join(apart, "token").groupBy("key", "root", "n").agg(F.count(F.lit(1)).alias("seen")), "simhash-seen")
    both = often(found.where("part = -1").select(*pair)).where("met < need")
    for end in "ab":
        both = both.join(seen.select(F.col("key").alias(f"k{end}"), F.col("root").alias(f"root_{end}"), F.col("seen").alias(f"seen_{end}")), f"k{end}")
    both = staged(both.where((F.col("root_a") != F.col("root_b")) & (F.col("met") + F.least("seen_a", "seen_b") >= F.col("need"))).select("ka", "kb"), "simhash-both")
    # the smallest set that may be similar has the least meetings
    enough = seen.where(F.col("seen") >= _meetings_column(_shared_column(F.col("n"), similarity), similarity)).select("key", "root")
    keys = both.select(F.col("ka").alias("key")).unionByName(both.select(F.col("kb").alias("key"))).unionByName(enough.select("key")).distinct()
    ends = staged(keys.join(classes.select(F.col("d0").alias("key"), F.col("node.id.tag").alias("tag")), "key"), "simhash-ends")
    if ends.isEmpty():
        return classes
    made = sets_of(ends.select("tag"))
    met = _crowd_meetings(ends.join(enough, "key").join(made, "tag"), similarity, bucket_cap)
    return join(classes, both.unionByName(often(met).where("met >= need").select("ka", "kb")), made)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2, words: int = 1, n_segments: int | None = None, bucket_cap: int = BUCKET_CAP,
) -> DataFrame:
    """id, f0.., component_id (smallest id of the component), one row per input row: linked by their fingerprints."""
    names = [f"f{k}" for k in range(words)]
    own = staged(fingerprints(docs, id_col, text_col, shingle, words), "simhash-fp")
    classes = _classes(own, names, max_bits=max_bits, n_segments=n_segments, bucket_cap=bucket_cap)
    # both sides are plain tables, so that a fingerprint of very many copies can be split over tasks
    return own.join(classes, names).select("id", *names, "component_id")


def similar_documents(
    docs: DataFrame, tag: str, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8,
    words: int = 4, n_segments: int = 12, width: int = 18, max_bits: int = 50, bucket_cap: int = BUCKET_CAP,
) -> DataFrame:
    """id (struct<no_id, id, tag>), component_id (the smallest such of the component), one row per input row: linked by the similarity of their shingles.

    ``docs`` has a column ``tag`` that names a row for good.  Fingerprints are
    of distinct shingles; rows whose sets of shingles are equal are one class.
    No link is lost: what fingerprints do not find, ``_remaining`` does.

    The defaults are for a similarity of 0.8 and more.  Texts of similarity 0.8
    differ in 15 % of the bits at the mean (39 of 256, deviation 6): a segment
    of 18 bits then differs by at most one with probability 0.22, one of 12
    with 0.95 (at 0.85: 0.99), and 50 bits are exceeded by 1 in 40.
    """
    names = [f"f{k}" for k in range(words)]
    order = F.struct(quoted(id_col).isNull().alias("no_id"), quoted(id_col).alias("id"), quoted(tag).alias("tag"))
    common, counts, parts = _common(docs, tag, text_col, shingle, bucket_cap)
    own = staged(_sketches(docs, order, text_col, shingle, words, similarity, common, counts), "simhash-fp")
    # nodes are in the order of their identifiers, so that a component's root carries its identifier
    first = own.groupBy("d0", "d1").agg(F.min(F.struct("id", *names)).alias("first"))
    sets = staged(first.select("d0", "d1", F.col("first.id").alias("id"), *[F.col("first")[n].alias(n) for n in names]), "simhash-sets")
    node = F.struct("id", "d0", "d1")
    distinct = staged(sets.groupBy(*names).agg(F.min(node).alias("first"), F.count(F.lit(1)).alias("of")), "simhash-distinct")

    def sets_of(ends: DataFrame) -> DataFrame:
        return shingle_sets(ends, docs, tag, text_col, shingle)

    def join(classes: DataFrame, pairs: DataFrame, made: DataFrame | None = None) -> DataFrame:
        """``classes`` joined by the pairs of keys (ka, kb) that are similar; ``made``: the sets, if they are there."""
        pairs = staged(pairs.distinct(), "simhash-pairs")
        if pairs.isEmpty():
            return classes
        for end in "ab":
            pairs = pairs.join(classes.select(F.col("d0").alias(f"k{end}"), F.col("node.id.tag").alias(f"tag_{end}"), F.col("root").alias(end)), f"k{end}")
        pairs = staged(pairs.select("a", "b", "tag_a", "tag_b"), "simhash-pairs")
        if made is None:
            made = sets_of(staged(pairs.select(F.col("tag_a").alias("tag")).unionByName(pairs.select(F.col("tag_b").alias("tag"))).distinct(), "simhash-ends"))
        met = similar(pairs, made, similarity)
        roots = staged(components(met.select("a", "b")).select(F.col("node").alias("root"), F.col("root").alias("now")), "simhash-roots")
        return staged(classes.join(roots, "root", "left").select("d0", "d1", "node", F.coalesce("now", "root").alias("root")), "simhash-classes")

    met = _ends(links(distinct, names, max_bits, n_segments, bucket_cap, width), distinct, names, F.col("first"))
    same = sets.join(distinct.where("of > 1").select(*names, "first"), names).where((F.col("d0") != F.col("first.d0")) | (F.col("d1") != F.col("first.d1")))
    pairs = met.select(F.col("a.d0").alias("ka"), F.col("b.d0").alias("kb")).unionByName(same.select(F.col("first.d0").alias("ka"), F.col("d0").alias("kb")))
    classes = join(sets.select("d0", "d1", node.alias("node"), node.alias("root")), pairs)
    classes = _remaining(own, classes, join, sets_of, similarity, bucket_cap, parts)
    # both sides are plain tables, so that a set of very many copies can be split over tasks
    return own.select("id", "d0", "d1").join(classes.select("d0", "d1", F.col("root.id").alias("component_id")), ["d0", "d1"]).select("id", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row of each component of similar texts stays: the one with the smallest identifier.  The input's columns.

    A null identifier counts as larger than any other; rows that repeat the
    staying identifier are told apart by their places in the input.  ``kw``: as
    of ``similar_documents``.
    """
    tag = fresh("nd_tag", docs.columns)
    rows = tagged(docs, tag)
    found = similar_documents(rows, tag, id_col, text_col, **kw)
    gone = staged(found.where(F.col("id.tag") != F.col("component_id.tag")).select(F.col("id.tag").alias(tag)), "simhash-gone")
    return meet(rows, gone, tag, "left_anti").select([quoted(c) for c in docs.columns])


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")
