import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from cairnspark.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    at = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(at)


def brute(rows, min_docs, share, depleted=Q.DEPLETED_SHARE):
    tidy = lambda t: [re.sub(r"[\x20\x09-\x0D]+", " ", x).strip(" ").lower() for x in (t or "").split("\n") if WORD.search(x)]
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    docs, hosts = defaultdict(set), defaultdict(set)
    for _, t, h in rows:
        hosts[h].add(norm(t))
        for x in tidy(t):
            docs[h, x].add(norm(t))
    out = []
    for i, t, h in rows:
        n, chars, symbols, dup, rep = base(t)
        gone = sum(x.count(" ") + 1 for x in tidy(t) if len(docs[h, x]) > max(min_docs, share * len(hosts[h])))
        failed = n < 10 or 100 * rep > 20 * n
        out.append((i, n, chars, symbols, dup, rep, failed, not failed and not (n - gone < 10 and gone >= depleted * n), gone))
    return sorted(out, key=str)


def run(docs, **kw):
    v = Q.quality_verdicts(docs, **kw)
    return sorted(map(tuple, v.select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words").collect()), key=str)


def rows(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]


def test_odd_rows(odd):
    assert run(odd) == brute(rows(odd), Q.MIN_DOCS, Q.MAX_SHARE)


def test_against_brute_force_with_low_limits(documents, hot):
    for docs in (documents, hot):
        for n, share in ((1, 0.0), (2, 0.05)):
            assert run(docs, min_docs=n, max_share=share) == brute(rows(docs), n, share)


def test_repeated_windows(spark):
    texts = ["a b c d e a b c d e", "x " * 30, "a b c d e f a b c d e f g a b c d e", "a b c d", "a a a a a a", "a b c d e z a b c d e q b c d e f b c d e f"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("source", F.lit("s"))
    assert {r["id"]: r["n_repeat_words"] for r in Q.profile(docs.withColumn("t", F.col("doc_id")), "t").collect()} == {i: base(t)[4] for i, t in enumerate(texts)}


def test_boilerplate_goes_and_copies_stay(spark):
    menu = "home about contact imprint privacy terms help login\nall rights reserved by the owner of this page"
    own = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(30)), lambda k: F.concat(F.lit("w"), F.col("id") * 100 + k)), " ")
    text = F.when(F.col("id") < 100, F.concat(F.lit(menu + "\nshort tail "), F.col("id").cast("string"))).when(F.col("id") < 200, F.concat(F.lit(menu + "\n"), own)).otherwise(F.lit("one much copied text that is fine in itself and has\nmore than one line to it as well"))
    docs = spark.range(400).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("host").alias("source"))
    kept = {r["id"]: r["kept"] for r in Q.quality_verdicts(docs).collect()}
    assert not any(kept[i] for i in range(100)) and all(kept[i] for i in range(100, 400))
    assert Q.filter_quality(docs).count() == 300


def test_filter(odd):
    out = Q.filter_quality(odd)
    keep = sorted(str(r[0]) for r in brute(rows(odd), Q.MIN_DOCS, Q.MAX_SHARE) if r[7])
    assert out.columns == odd.columns and sorted(str(r["doc_id"]) for r in out.collect()) == keep
    assert Q.filter_quality(odd.limit(0)).count() == 0 and Q.quality_verdicts(odd.limit(0)).count() == 0


def without(text, host, docs, min_docs, share):
    """The text less its lines above the limit, by brute force; docs: rows of (id, text, host)."""
    tidy = lambda x: re.sub(r"[\x20\x09-\x0D]+", " ", x).strip(" ").lower()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    mine = {norm(t): t for _, t, h in docs if h == host}
    many = Counter((norm(t), tidy(x)) for _, t, h in docs if h == host for x in set((t or "").split("\n")) if WORD.search(x))
    docs_of = Counter(x for _, x in many)
    return "\n".join(x for x in text.split("\n") if not WORD.search(x) or docs_of[tidy(x)] <= max(min_docs, share * len(mine)))


def test_lines_above_the_limit_leave_the_text(spark, documents):
    menu = ["Home  about contact imprint", "all rights reserved by the owner\r"]
    own = [[f"word{i}x{k}" for k in range(20)] for i in range(60)]
    texts = ["\n".join([menu[i % 2], " ".join(w[:12]), "", menu[1 - i % 2], menu[0].upper(), " ".join(w[12:])]) for i, w in enumerate(own)]
    made = [(i, t, "h", len(t), "x") for i, t in enumerate(texts)] + [(100, texts[0], "other", 7, "y"), (101, "\n".join(map(" ".join, own[:3])), "h", -1, "z")]
    docs = spark.createDataFrame(made, "doc_id long, text string, source string, n_chars long, qr_gone string")
    want = [(i, "\n".join([" ".join(w[:12]), "", " ".join(w[12:])]), "h", "x") for i, w in enumerate(own)]
    want = [(i, t, h, len(t), x) for i, t, h, x in want] + made[-2:]  # what loses nothing stays as it is
    out = Q.filter_quality(docs)
    assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == want
    for n, share in ((1, 0.0), (2, 0.05)):
        all_rows = rows(documents)
        got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in Q.filter_quality(documents, min_docs=n, max_share=share).collect()}
        keep = {r[0] for r in brute(all_rows, n, share) if r[7]}
        left = {i: without(t, h, all_rows, n, share) for i, t, h in all_rows if i in keep}
        assert got == {i: (t, len(t)) for i, t in left.items()} and any(left[i] != t for i, t, _ in all_rows if i in keep)


def test_line_breaks_tell_texts_of_the_same_words_apart(spark):
    lines = ["home about contact imprint privacy terms", "all rights reserved by the owner here"]
    made = [(i, "\n".join([*lines, " ".join(f"w{i}x{k}" for k in range(20))]), "h") for i in range(40)]
    made += [(100, "\n".join(lines), "h"), (101, " ".join(lines), "h")]
    docs = spark.createDataFrame(made, "doc_id long, text string, source string")
    keep = sorted(r[0] for r in brute(made, Q.MIN_DOCS, Q.MAX_SHARE) if r[7])
    assert 100 not in keep and 101 in keep
    assert sorted(r["doc_id"] for r in Q.filter_quality(docs).collect()) == keep
