import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from cairnspark.llm import simhash as S


def slow_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.encode().replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ").replace(b"\r", b" ").split(b" ") if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, max_bits=2):
    fp = np.array([slow_fingerprint(t) for _, t in rows], dtype=np.uint64)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fp[i + 1 :] ^ fp[i]) <= max_bits) + i + 1:
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        if doc is not None:
            least[r] = min(doc, least.get(r, doc))
    return sorted((str(doc), int(fp[i]), least.get(find(i))) for i, (doc, _) in enumerate(rows))


def found(docs, **kw):
    return sorted((str(r["id"]), r["f0"] % (1 << 64), r["component_id"]) for r in S.near_duplicates(docs, **kw).collect())


def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("cap", [2, S.BUCKET_CAP])
def test_against_brute_force(documents, odd, hot, cap):
    for docs in (documents, odd, hot):
        assert found(docs, bucket_cap=cap) == brute(rows(docs))


def test_planted_fingerprints(spark):
    """Clusters of random fingerprints with 0 to 3 bits turned, chains among them, through both signature levels."""
    rng = np.random.default_rng(3)
    fps = []
    for c in rng.integers(0, 2**63, 30, dtype=np.uint64):
        for _ in range(rng.integers(1, 20)):
            x = int(c)
            for b in rng.integers(0, 64, rng.integers(0, 4)):
                x ^= 1 << int(b)
            fps.append(x)
    u = np.unique(np.array(fps, dtype=np.uint64))
    distinct = spark.createDataFrame([(int(x.view(np.int64)),) for x in u], "f0 long")
    for max_bits, caps in ((1, (2, 1024)), (2, (4, 1024)), (3, (1024,))):
        near = {(int(a), int(b)) for i, a in enumerate(u) for b in u[i + 1 :][np.bitwise_count(u[i + 1 :] ^ a) <= max_bits]}
        want = groups(u.tolist(), near)
        for cap in caps:
            got = {(r[0] % (1 << 64), r[1] % (1 << 64)) for r in S.links(distinct, ["f0"], max_bits, None, cap).collect()}
            assert all(bin(a ^ b).count("1") <= max_bits for a, b in got)
            assert groups(u.tolist(), got) == want


def test_buckets_over_the_cap_lose_no_pair(spark):
    """Links beyond the guarantee do not hang on how full a bucket is: pairs at 18 to 38 bits that share a segment, and a hot template around them."""
    rng = np.random.default_rng(11)
    names, turned = ["f0", "f1", "f2"], lambda fp, bits: [int(x) ^ sum(1 << int(b % 64) for b in bits if b // 64 == w) for w, x in enumerate(fp)]
    free = np.setdiff1d(np.arange(192), np.arange(21))  # the first segment stays, so that all of a family meet in its buckets
    fps = []
    for _ in range(3):
        first = int(rng.integers(0, 1 << 21))
        for _ in range(25):
            base = rng.integers(0, 1 << 64, 3, dtype=np.uint64).tolist()
            base[0] = (base[0] & ~((1 << 21) - 1)) | first
            fps += [base, turned(base, rng.choice(free, rng.integers(18, 39), replace=False))]
    rows_ = sorted({tuple(int(np.uint64(x).view(np.int64)) for x in f) for f in fps})
    distinct = spark.createDataFrame(rows_, "f0 long, f1 long, f2 long")
    found_ = lambda cap: groups(rows_, {(tuple(r)[:3], tuple(r)[3:]) for r in S.links(distinct, names, 38, 9, cap).collect()})
    whole = found_(1 << 20)
    assert len(whole) == 75  # every planted pair, and nothing more
    for cap in (1, 3, 30):
        assert found_(cap) == whole


def groups(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    out = {}
    for n in nodes:
        out.setdefault(find(n), set()).add(n)
    return {frozenset(g) for g in out.values()}


def test_blocks_do_not_matter(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000)) + "\n\n x"
    whole = S.fingerprint(text)
    assert whole == [slow_fingerprint(text)]
    monkeypatch.setattr(S.word_blocks, "__defaults__", (37,))
    assert S.fingerprint(text) == whole
    assert S.fingerprint("A b") == [slow_fingerprint("a B")] and S.fingerprint(None) == [0]


def test_runs():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(0, 120))
        key, value = np.sort(rng.integers(0, rng.integers(1, 20), n)), np.arange(n)
        cuts = [0, *np.sort(rng.integers(0, n + 1, 6)).tolist(), n]
        batches = [pa.RecordBatch.from_arrays([pa.array(key[a:z]), pa.array(value[a:z])], ["k", "v"]) for a, z in zip(cuts, cuts[1:])]
        cap, got = int(rng.integers(1, 9)), {True: {}, False: {}}
        for rows_, over in S._runs(iter(batches), 1, cap):
            for k, v in rows_:
                got[over].setdefault(int(k), []).append(int(v))
        want = {int(k): value[key == k].tolist() for k in np.unique(key)}
        assert got[True] == {k: v for k, v in want.items() if len(v) > cap}
        assert got[False] == {k: v for k, v in want.items() if len(v) <= cap}


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).unionByName(spark.createDataFrame([(500, 501), (502, 501)], "a long, b long"))
    roots = {r["node"]: r["root"] for r in S.components(edges).collect()}
    assert roots == {i: 0 for i in range(201)} | {500: 500, 501: 500, 502: 500}
    assert S.components(edges.limit(0)).count() == 0


def test_dropping(spark, odd, hot):
    base = " ".join(f"w{i}" for i in range(400))
    near = base.replace("w200 ", "w200x ")
    docs = spark.createDataFrame([(9, near, "k"), (4, base, None), (4, base, "r"), (None, base, "n"), (7, "other " + " ".join(f"v{i}" for i in range(300)), "o")], "doc_id long, text string, nd_tag string")
    out = S.drop_near_duplicates(docs)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [4, 7]
    assert S.drop_near_duplicates(docs.limit(0)).count() == 0
    assert S.drop_near_duplicates(odd).columns == odd.columns
    # of the copies and near copies one stays, of the others all
    assert S.drop_near_duplicates(hot).count() == 201


def exact_groups(rows_, similarity=0.8, k=5):
    """Pairs of at least that similarity of their distinct shingles, and the components of these, by brute force."""
    sets = []
    for _, t in rows_:
        words = (t or "").lower().split()
        sets.append({" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set())
    pairs = set()
    for i, x in enumerate(sets):
        for j in range(i + 1, len(sets)):
            y = sets[j]
            if min(len(x), len(y)) >= similarity * max(len(x), len(y)) and len(x & y) >= similarity * len(x | y):
                pairs.add((i, j))
    return pairs


@pytest.fixture(scope="module")
def near_pairs(spark):
    """Texts of 60 to 400 invented words, each with copies whose words are exchanged at rates around what similarity 0.8 allows; on no table that widths were chosen on."""
    rng = np.random.default_rng(23)
    word = lambda: "".join(chr(97 + int(c)) for c in rng.integers(0, 26, rng.integers(2, 7)))
    rows_, n = [], 0
    for _ in range(150):
        base = [word() for _ in range(int(rng.integers(60, 400)))]
        for rate in (0.0, float(rng.uniform(0.0, 0.05)), float(rng.uniform(0.0, 0.12))):
            rows_.append((n, " ".join(word() if rng.random() < rate else w for w in base)))
            n += 1
    return rows_


def test_similar_documents_against_exact_sets(spark, near_pairs):
    docs = spark.createDataFrame(near_pairs, "doc_id long, text string").withColumn("t", F.struct(F.lit(0).cast("long").alias("file"), F.col("doc_id").alias("row")))
    pairs = exact_groups(near_pairs)
    want = groups(range(len(near_pairs)), pairs)
    of_all = {i: g for g in want for i in g}
    got = {}
    for r in S.similar_documents(docs, "t").collect():
        got.setdefault(r["component_id"]["id"], set()).add(r["id"]["id"])
    together = {i: g for g in got.values() for i in g}
    # nothing is joined that exact similarity does not join
    assert all(g <= of_all[next(iter(g))] for g in got.values())
    found_ = sum(j in together[i] for i, j in pairs)
    print(found_, len(pairs))
    assert len(pairs) > 100 and found_ >= 0.9 * len(pairs)


def components_of(docs, **kw):
    docs, got = docs.withColumn("t", F.struct(F.lit(0).cast("long").alias("file"), F.col("doc_id").alias("row"))), {}
    for r in S.similar_documents(docs, "t", **kw).collect():
        got.setdefault(r["component_id"]["id"], set()).add(r["id"]["id"])
    assert all(root == min(g) for root, g in got.items())
    return {frozenset(g) for g in got.values()}


@pytest.mark.parametrize("kw", [{}, {"max_bits": 1, "bucket_cap": 16}, {"max_bits": 1, "bucket_cap": 2}])
def test_similar_documents_lose_no_link(spark, near_pairs, kw):
    """All components of exact sets, also of pairs that meet in no segment or differ by more bits than asked for."""
    docs = spark.createDataFrame(near_pairs, "doc_id long, text string")
    assert components_of(docs, **kw) == groups(range(len(near_pairs)), exact_groups(near_pairs))


@pytest.mark.parametrize("kw", [{}, {"max_bits": 1}, {"bucket_cap": 8}])
def test_similar_documents_of_a_crowd(spark, kw):
    """One long passage with endings of many lengths: all texts meet in the same buckets, and some are just similar, some just not."""
    rng = np.random.default_rng(31)
    base, rows_ = [f"b{i}" for i in range(100)], []
    for n in range(160):
        cut, own = int(rng.integers(0, 12)), int(rng.integers(0, 40))
        rows_.append((n, " ".join(base[cut:] + [f"o{n % 90}x{k}" for k in range(own)])))
    rows_ += [(n, t) for n, t in enumerate(["", " ", "one", "One", "one two three four five six", "one two three four five six seven"], 160)]
    docs = spark.createDataFrame(rows_, "doc_id long, text string")
    assert components_of(docs, **kw) == groups(range(len(rows_)), exact_groups(rows_))


def test_candidates_of_a_crowd_do_not_grow_with_its_square(spark, monkeypatch):
    """Drafts of one text, most of them just too far from it and from each other: the links are exact, and beyond what fingerprints find few pairs are looked at."""
    rng, made, staged, drafts = np.random.default_rng(41), [], S.staged, 160

    def kept(df, name):
        made.append((name, staged(df, name)))
        return made[-1][1]

    monkeypatch.setattr(S, "staged", kept)
    rows_ = [(0, " ".join(f"b{i}" for i in range(300)))]
    for n in range(1, drafts + 1):
        words = [f"b{i}" for i in range(300)]
        for i in rng.choice(np.arange(6, 294, 6), 5 if n % 8 == 0 else 7, replace=False):
            words[i] = f"d{n}x{i}"
        rows_.append((n, " ".join(words)))
    assert components_of(spark.createDataFrame(rows_, "doc_id long, text string")) == groups(range(len(rows_)), exact_groups(rows_))
    looked_at = [df.count() for name, df in made if name == "simhash-pairs" and df.columns == ["ka", "kb"]]
    assert sum(looked_at[1:]) <= 4 * drafts, looked_at


def test_meetings_of_a_crowd_without_shingles_of_its_own(spark, monkeypatch):
    """Drafts that choose among three wordings in 24 places: no shingle is one draft's alone, and hardly any two are similar.  What is written is about those that are."""
    rng, made, map_arrow, drafts = np.random.default_rng(47), [], S.map_arrow, 160

    def kept(df, function, schema):
        made.append((function.__name__, map_arrow(df, function, schema)))
        return made[-1][1]

    monkeypatch.setattr(S, "map_arrow", kept)
    chosen = rng.integers(0, 3, (drafts, 24))
    twins = chosen[::20].copy()
    twins[:, rng.choice(24, 5, replace=False)] += 1
    rows_ = [(n, " ".join(f"v{c[i // 12] % 3}x{i}" if i % 12 == 6 else f"b{i}" for i in range(288))) for n, c in enumerate(np.vstack([chosen, twins]))]
    pairs = exact_groups(rows_)
    assert len(pairs) >= 8
    # one bit at most, so that fingerprints find nearly no link
    assert components_of(spark.createDataFrame(rows_, "doc_id long, text string"), max_bits=1) == groups(range(len(rows_)), pairs)
    written = [df.count() for name, df in made if name == "compare_all"]
    assert written and sum(written) <= 4 * len(rows_), written


def test_masks_allow_all_that_is_similar():
    """Whatever bits shingles fall on, and however full masks are, no pair of the similarity is left out; pairs far from it are, while masks are not full."""
    rng, out = np.random.default_rng(53), 0
    for n in (*rng.integers(1, 400, 300).tolist(), *rng.integers(400, 6000, 20).tolist()):
        a = rng.integers(-(1 << 63), 1 << 63, n)
        for lost in (int(n / 9), n // 2):  # of either set, exchanged for others
            b = np.concatenate([a[lost:], rng.integers(-(1 << 63), 1 << 63, lost)])
            rows_ = np.hstack([[[1, 1, n, n], [2, 2, n, n]], S._masks(np.concatenate([a, b]), np.array([n, n]))])
            may = S._masks_allow(rows_, np.array([0, 1]), np.array([1, 0]), 0.8)
            assert may[0] == may[1] and (may[0] or (n - lost) / (n + lost) < 0.8)
            out += not may[0]
    assert out > 250


def test_needed_shingles_of_two_sets():
    """No pair of the similarity shares fewer of its first shingles than is asked for, however its shingles fall in the order."""
    rng = np.random.default_rng(43)
    for _ in range(3000):
        shared = int(rng.integers(1, 120))
        most = int(shared / 0.8 + 1e-9) - shared  # how many shingles may be in one set only
        of_a = int(rng.integers(0, most + 1))
        a, b = np.array([shared + of_a]), np.array([shared + int(rng.integers(0, most - of_a + 1))])
        order = rng.random(shared + int(a[0]) + int(b[0]) - 2 * shared) if rng.random() < 0.5 else np.linspace(1, 0, int(a[0]) + int(b[0]) - shared)
        common = order[:shared]
        x, y = (np.sort(np.concatenate([common, own])) for own in (order[shared : int(a[0])], order[int(a[0]) :]))
        first = [set(v[: len(v) - int(S._shared(n, 0.8)[0]) + int(S._meetings(n, 0.8)[0])]) for v, n in ((x, a), (y, b))]
        assert shared >= S._shared_by(a, b, 0.8)[0]
        assert len(first[0] & first[1]) >= S._needed(a, b, 0.8)[0]


def test_caps_do_not_matter_for_similar_documents(spark, hot):
    docs = hot.where("doc_id < 300").withColumn("t", F.struct(F.lit(0).cast("long").alias("file"), F.col("doc_id").alias("row")))
    of = lambda cap: sorted((r["id"]["id"], r["component_id"]["id"]) for r in S.similar_documents(docs, "t", bucket_cap=cap).collect())
    assert of(4) == of(1024)


def test_near_gives_all_links_or_a_least_forest():
    rng = np.random.default_rng(5)
    for n, spread in ((40, 128), (300, 40), (600, 6)):
        base = rng.integers(0, 1 << 64, 2, dtype=np.uint64)
        u = np.repeat(base[None], n, axis=0)
        for row in u:
            for b in rng.integers(0, 128, rng.integers(0, spread)):
                row[b // 64] ^= np.uint64(1) << np.uint64(b % 64)
        u = np.unique(u, axis=0)
        d = np.bitwise_count(u[:, None] ^ u[None]).sum(axis=2)
        for top in (4, 12, 30):
            a, b = S._near(u, top)
            assert len(a) <= max(S.LINKS_EACH, 1) * len(u)
            for bits in range(1, top + 1, 5):
                want = {(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(d <= bits, 1)))}
                assert groups(range(len(u)), [(int(i), int(j)) for i, j in zip(a, b) if d[i, j] <= bits]) == groups(range(len(u)), want)


def test_query(spark, sf_dir, documents):
    got = sorted((str(r["doc_id"]), int(r["fingerprint"], 16), r["component_id"]) for r in S.op3_simhash(spark, sf_dir).collect())
    assert got == brute(rows(documents)) and all(len(r["fingerprint"]) == 16 for r in S.op3_simhash(spark, sf_dir).limit(5).collect())
