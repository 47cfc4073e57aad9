import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from cairnspark.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text):
            d = re.sub(r"[^0-9]", "", m[0])
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda: 16 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0,
                "phone": lambda: 8 <= len(d) <= 15,
            }[kind]()
            if ok:
                out.append((kind, *m.span()))
    return out


def base(text):
    return [f for f in pii.Finder().find(text) if f[0] in pii.BASE_KINDS]


def test_random_texts_against_regular_expressions():
    rng = random.Random(5)
    for alphabet in ("a1.@", "0129 -+().", "ab.@-+ 0123456789", "a@.\n+1 é🙂"):
        for _ in range(4000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
            assert base(text) == brute(text), text


@pytest.mark.parametrize("text", ["", "@", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111 2", "+1 (017) 555-7713", "+4915112345678+1", "000000000001.2.3.4", "1" * 4000 + ".1.1.1"])
def test_cases(text):
    assert base(text) == brute(text)


def test_extra_kinds():
    kinds = lambda t: [(k, t[a:z]) for k, a, z in pii.Finder().find(t) if k not in pii.BASE_KINDS]
    assert kinds("IBAN: DE89 3704 0044 0532 0130 00.") == [("account", "DE89 3704 0044 0532 0130 00")]
    assert kinds("IBAN: DE88 3704 0044 0532 0130 00.") == []
    assert kinds("Account number: 12345678") == [("account", "12345678")]
    assert kinds("on account of the 12 men") == []
    assert kinds("see https://joe:pw1@host.example/x") == [("login", "joe:pw1@host.example")]


def test_logins_of_any_length():
    for user, password, host in (("joe", "t" * 150, "host.example"), ("u" * 65, "p", "h" * 300), ("u" * 100_000, "p" * 100_000, "host")):
        text = f"see https://{user}:{password}@{host}/x"
        assert [text[a:z] for k, a, z in pii.Finder().find(text) if k == "login"] == [f"{user}:{password}@{host}"]


def test_table_with_nulls_and_clashing_names(spark):
    rows = [(1, "mail a@b.de", "x", None), (None, None, None, "p"), (1, "mail a@b.de", "x", None), (2, "", "y", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pii string, n_email string")
    out = pii.find_pii(docs)
    assert out.columns == [*docs.columns, "pii_"] and out.drop("pii_").exceptAll(docs).count() == 0
    assert sorted(len(r.pii_) for r in out.collect()) == [0, 0, 1, 1]
    red = pii.redact(docs)
    assert red.columns == docs.columns
    assert sorted(("-" if r.text is None else r.text) for r in red.collect()) == ["", "-", "mail <email>", "mail <email>"]
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    got = {r.doc_id: r for r in pii.op4_pii(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert len(got) == len(docs)
    for d in docs:
        want = brute(d.text)
        r = got[d.doc_id]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(f[0] == k for f in want) for k in pii.BASE_KINDS)
        joined = ",".join(f"{k}:{a}:{z}" for k, a, z in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))
