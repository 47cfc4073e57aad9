"""Best-fit packing by bin completion, on a histogram of lengths.

1. *Tokens.*  Each text becomes ids and an end mark; only what is longer than
   a sequence is cut.  A task numbers its pieces of each length as it goes, so
   that a piece is known by (length, task, number).
2. *Histogram.*  How often each length occurs: at most ``capacity`` numbers,
   whatever the corpus, and all that packing depends on.
3. *Bin completion.*  Best fit decreasing gives the first solution (the
   incumbent); one that puts the fullest filling around the largest remaining
   length, as often as the lengths last, the second.  Where the better one has
   more sequences than the lower bound, its last sequences are opened again, 8,
   then twice as many, up to all: branch and bound looks for a packing of
   their lengths in one sequence less.  Around the largest remaining length,
   all undominated fillings are tried, least waste first (a filling is
   dominated if a length of it could be exchanged for a longer one that also
   fits, or one more would fit); a branch ends where its waste exceeds what one
   sequence less leaves to waste.  What is found becomes the incumbent, until
   the bound is met or ``steps`` fillings were looked at.  With fewer steps than
   that takes, the result is the incumbent: that is the one limit of the search.
4. *Places.*  Ranks within a length (offsets per task plus the number) are laid
   over the fillings' slots in order; every piece finds its sequence alone.

The driver holds the histogram and the fillings, both bounded by ``capacity``;
no shuffle carries text, and no task gathers the pieces of a length.

Defined cases.  Null text is empty: one token, the end mark.  Repeated rows are
packed each for itself.  An empty table gives an empty result.  Very long texts
are tokenised in a piece, whole.  Extra columns are never looked at.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_arrow, quoted, staged, table

CAPACITY = 2048
END_ID = 0
#: Steps of the search for one filling, and of the search over sequences.
SEARCH_STEPS, BRANCH_STEPS = 4000, 30_000
#: Beyond so many sequences at a time none are opened again: the recursion is as deep.
MOST_OPENED = 256
#: Words that a process remembers.
CACHE_WORDS = 600_000


class WordTokens:
    """Ids of texts, as little-endian unsigned 32-bit bytes, equal to those of the tokenizer.

    The tokenizer lower-cases, splits by a fixed pattern and encodes each part
    for itself, the last token of a part being marked as its end.  So parts are
    encoded once, all new ones of a block of text in one call, and remembered
    while they recur.  Only texts of ASCII and the Latin letters up to U+017F
    take that way, for which pattern, case and composition are the same
    everywhere; others, and all texts if the file is of another kind of
    tokenizer, go through the tokenizer whole.
    """

    #: Fixed value: the tokenizer file's own pattern.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    #: The same for lower-case letters up to U+017F.
    PARTS = re.compile(r"[a-zß-öø-ÿĀ-ſ]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\sa-zß-öø-ÿĀ-ſ0-9]+")
    OTHER = re.compile(r"[^\t-\r -~À-ÖØ-öø-įı-ňŊ-ž]|<\|")

    PLAIN = bytes([*range(9, 14), *range(32, 127)])

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # the same model for parts: they are normal and split already, and each comes once
        own = json.loads(self.tokenizer.to_str())
        self.by_parts = own["model"].get("end_of_word_suffix") == "</w>" and json.dumps(self.PATTERN) in json.dumps(own["pre_tokenizer"])
        plain = own | {"normalizer": None, "post_processor": None, "added_tokens": []}
        plain["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "CharDelimiterSplit", "delimiter": " "}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
        self.parts = Tokenizer.from_str(json.dumps(plain))
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        self.recent: set[str] = set()

    def _special(self, text: str) -> bool:
        """Whether the text must go through the tokenizer whole."""
        if text.isascii():
            return "<|" in text or bool(text.encode().translate(None, self.PLAIN))
        return bool(self.OTHER.search(text))

    def _ids(self, text: str, tokenizer=None) -> np.ndarray:
        return np.array((tokenizer or self.tokenizer).encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn(self, parts: set[str]) -> None:
        if len(self.known) > CACHE_WORDS:  # those of late stay
            self.known = {p: self.known[p] for p in self.recent}
            self.recent = set()
        self.recent |= parts
        new = list(parts.difference(self.known))
        if not new:
            return
        ids = self._ids(" ".join(new), self.parts)
        stops = (np.flatnonzero(self.ends[ids]) + 1) * 4
        assert len(stops) == len(new), "a part has one end"
        data, at = ids.tobytes(), 0
        for p, z in zip(new, stops.tolist(), strict=True):
            self.known[p] = data[at:z]
            at = z

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [None if not self.by_parts or self._special(t) else self.PARTS.findall(t.lower()) for t in texts]
        self._learn(set().union(*(p for p in split if p)))
        get = self.known.__getitem__
        return [self._ids(t).tobytes() if p is None else b"".join(map(get, p)) for t, p in zip(texts, split, strict=True)]


_tokens: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """One for each process: a reused worker keeps what it has learnt."""
    if path not in _tokens:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _tokens[path] = WordTokens(path)
    return _tokens[path]


def _blocks(texts: pa.Array, size: int = 1 << 20) -> Iterator[list[str]]:
    """The texts, in order, in lists of about ``size`` characters."""
    block, n = [], 0
    for t in texts:
        block.append(t.as_py() or "")
        n += len(block[-1])
        if n >= size:
            yield block
            block, n = [], 0
    if block:
        yield block


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """id, piece, start, length, ids_crc32, task, number: the pieces, numbered by length within each task."""
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    end = np.array([END_ID], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(tokenizer_path or word_bpe_path())
        task, counts = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in batches:
            at, out = [], []
            for k, ids in enumerate(ids for block in _blocks(b.column(1)) for ids in tokens(block)):
                ids += end
                for piece, a in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[a : a + 4 * capacity]
                    n = len(part) // 4
                    at.append(k)
                    out.append((piece, a // 4, n, zlib.crc32(part), task, counts[n]))
                    counts[n] += 1
            if out:
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at)), pa.array(cols[0], pa.int32()), *[pa.array(np.array(c, dtype=np.int64)) for c in cols[1:4]], pa.array(cols[4], pa.int32()), pa.array(np.array(cols[5], dtype=np.int64))],
                    ["id", "piece", "start", "length", "ids_crc32", "task", "number"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    return map_arrow(rows, cut, f"id {kind}, piece int, start long, length long, ids_crc32 long, task int, number long")


def _best_fit(lengths: np.ndarray, counts: np.ndarray, room: int) -> list[int]:
    """Best-fit filling of ``room``: the largest length that fits, again and again.  Indices into ``lengths`` (ascending)."""
    used: dict[int, int] = {}
    out = []
    while True:
        i = int(np.searchsorted(lengths, room, side="right")) - 1
        while i >= 0 and counts[i] - used.get(i, 0) <= 0:
            i -= 1
        if i < 0:
            return out
        used[i] = used.get(i, 0) + 1
        out.append(i)
        room -= int(lengths[i])


def complete(lengths: list[int], counts: list[int], room: int, steps: int = SEARCH_STEPS) -> list[int]:
    """The filling of ``room`` with least waste; among equal ones the one with the longest members.

    ``lengths`` ascending, all with counts above 0.  Depth first, members in
    descending order.  The best-fit filling is the first incumbent.  A branch
    ends when all that may still be added wastes as much as the incumbent,
    and the search when nothing is wasted or after ``steps``.  A filling in
    which a member could be exchanged for a longer one that fits has more
    waste than the exchanged one, so dominated fillings never stay incumbents.
    """
    n = np.array(lengths)
    best = _best_fit(n, np.array(counts), room)
    least = room - sum(lengths[i] for i in best)
    reach = np.cumsum(n * np.array(counts)).tolist()  # the most that lengths up to i can fill
    left, budget = list(counts), steps

    def search(free: int, top: int, chosen: list[int]) -> None:
        nonlocal best, least, budget
        if free < least:
            best, least = list(chosen), free
        i = min(top, int(np.searchsorted(n, free, side="right")) - 1)
        while i >= 0 and least and budget > 0 and free - reach[i] < least:
            if left[i] > 0:
                budget -= 1
                left[i] -= 1
                chosen.append(i)
                search(free - lengths[i], i, chosen)
                chosen.pop()
                left[i] += 1
            i -= 1

    if least:
        search(room, len(lengths) - 1, [])
    return best


def lower_bound(histogram: dict[int, int], capacity: int) -> int:
    """Sequences that any packing takes: of all lengths; or of those above half, each in its own, and what of the middle ones (at least k) has no room beside them."""
    lengths = sorted(k for k, n in histogram.items() if n > 0)
    most = -(-sum(k * histogram[k] for k in lengths) // capacity)
    for k in [0, *(x for x in lengths if 2 * x <= capacity)]:
        alone = sum(histogram[x] for x in lengths if x > capacity - k)
        large = [x for x in lengths if capacity < 2 * x <= 2 * (capacity - k)]
        middle = sum(x * histogram[x] for x in lengths if k <= x and 2 * x <= capacity)
        n = sum(histogram[x] for x in large)
        room = sum((capacity - x) * histogram[x] for x in large)
        most = max(most, alone + n + max(0, -(-(middle - room) // capacity)))
    return most


def undominated(have: dict[int, int], room: int, slack: int, budget: list[int]) -> list[tuple[int, ...]]:
    """The undominated fillings of ``room`` from ``have`` (length -> how many) that waste at most ``slack``, least waste first, then longest members.  ``budget``: steps left, in a list of one."""
    lengths = sorted(k for k, n in have.items() if n > 0 and k <= room)
    reach = np.cumsum([k * have[k] for k in lengths]).tolist()
    out, chosen = [], {}

    def dominated(free: int) -> bool:
        for k in lengths:
            if have[k] > chosen.get(k, 0):  # this one is left over
                if k <= free or any(m and j < k <= j + free for j, m in chosen.items()):
                    return True
        return False

    def grow(free: int, top: int) -> None:
        budget[0] -= 1
        if not dominated(free) and free <= slack:
            out.append((free, tuple(k for k in sorted(chosen, reverse=True) for _ in range(chosen[k]))))
        i = min(top, int(np.searchsorted(lengths, free, side="right")) - 1)
        while i >= 0 and budget[0] > 0 and free - reach[i] <= slack:
            k = lengths[i]
            for m in range(min(have[k], free // k), 0, -1):
                chosen[k] = m
                grow(free - m * k, i - 1)
                del chosen[k]
            i -= 1

    grow(room, len(lengths) - 1)
    return [f for _, f in sorted(out, key=lambda f: (f[0], [-k for k in f[1]]))]


def branch(have: dict[int, int], capacity: int, most: int, budget: list[int]) -> list[tuple[int, ...]] | None:
    """A packing of ``have`` in at most ``most`` sequences; None if there is none, or ``budget`` is used up."""
    have = {k: n for k, n in have.items() if n > 0}

    def place(slack: int) -> list[tuple[int, ...]] | None:
        left = [k for k, n in have.items() if n > 0]
        if not left:
            return []
        top = max(left)
        have[top] -= 1
        for filling in undominated(have, capacity - top, slack, budget):
            for k in filling:
                have[k] -= 1
            rest = place(slack - (capacity - top - sum(filling)))
            for k in filling:
                have[k] += 1
            if rest is not None:
                have[top] += 1
                return [(top, *filling), *rest]
            if budget[0] <= 0:
                break
        have[top] += 1
        return None

    slack = most * capacity - sum(k * n for k, n in have.items())
    return place(slack) if slack >= 0 else None


def _grouped(fills: list[tuple[int, ...]]) -> list[tuple[tuple[int, ...], int]]:
    return list(Counter(fills).items())


def _better(fills: list[tuple[tuple[int, ...], int]], capacity: int, bound: int, steps: int) -> list[tuple[tuple[int, ...], int]]:
    """``fills`` with ever more of its last sequences packed anew, while that saves one and ``steps`` last."""
    n, opened, budget = sum(t for _, t in fills), 8, [steps]
    while n > bound and budget[0] > 0:
        kept, tail, want = list(fills), Counter(), min(opened, n)
        left = want
        while left:  # the last sequences, of which one filling may stand for many
            filling, times = kept.pop()
            took = min(times, left)
            for k in filling:
                tail[k] += took
            if took < times:
                kept.append((filling, times - took))
            left -= took
        # a share of what is left, so that a small tail that cannot be bettered leaves steps for a larger one
        mine = [budget[0] if want == n else budget[0] // 2 + 1]
        before = mine[0]
        found = branch(tail, capacity, want - 1, mine)
        budget[0] -= before - max(0, mine[0])
        if found is not None:
            fills, n = kept + _grouped(found), n - 1
        elif want == n or opened > MOST_OPENED:
            break
        else:
            opened *= 2
    return fills


def fillings(histogram: dict[int, int], capacity: int = CAPACITY, steps: int = SEARCH_STEPS, branch_steps: int = BRANCH_STEPS) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths of a sequence, times)] for all pieces of the histogram."""
    best = min((_fill(histogram, capacity, s) for s in (steps, 0)), key=lambda f: sum(t for _, t in f))
    return _better(best, capacity, lower_bound(histogram, capacity), branch_steps)


def _fill(histogram: dict[int, int], capacity: int, steps: int) -> list[tuple[tuple[int, ...], int]]:
    have = {k: v for k, v in histogram.items() if v > 0}
    lengths = sorted(have)
    out = []
    while lengths:
        top = lengths[-1]
        have[top] -= 1
        live = [k for k in lengths if have[k]]
        rest = [live[i] for i in complete(live, [have[k] for k in live], capacity - top, steps)] if steps else [live[i] for i in _best_fit(np.array(live, dtype=np.int64), np.array([have[k] for k in live]), capacity - top)]
        have[top] += 1
        filling = (top, *rest)
        times = min(have[k] // filling.count(k) for k in set(filling))
        for k in set(filling):
            have[k] -= times * filling.count(k)
        lengths = [k for k in lengths if have[k]]
        out.append((filling, times))
    return out


def _slots(fills: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """length -> rows (first rank, first sequence, pieces of it in a sequence, offset of the first of them), by rank."""
    slots: dict[int, list] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for filling, times in fills:
        offset = 0
        for k in dict.fromkeys(filling):
            m = filling.count(k)
            slots.setdefault(k, []).append((ranks.get(k, 0), sequence, m, offset))
            ranks[k] = ranks.get(k, 0) + m * times
            offset += m * k
        sequence += times
    return {k: np.array(v, dtype=np.int64) for k, v in slots.items()}


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None,
    capacity: int = CAPACITY, steps: int = SEARCH_STEPS,
) -> DataFrame:
    """id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    cut = staged(pieces(docs, id_col, text_col, tokenizer_path, capacity), "packing-pieces")
    per_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").count().withColumnRenamed("count", "n").collect()}  # at most capacity rows
    slots = _slots(fillings(histogram, capacity, steps))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = cut.join(offsets, ["length", "task"]).select("id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("number")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for k in np.unique(length):
                mine, s = length == k, slots[int(k)]
                row = s[np.searchsorted(s[:, 0], rank[mine], side="right") - 1]
                nth = rank[mine] - row[:, 0]
                sequence[mine] = row[:, 1] + nth // row[:, 2]
                offset[mine] = row[:, 3] + nth % row[:, 2] * k
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)], ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = cut.schema["id"].dataType.simpleString()
    return map_arrow(ranked, place, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumnRenamed("id", "doc_id")
