"""Secret scan: candidate tokens, and a random forest that removes false positives (DataFrame functions only).

*Candidates* are found in the whole text by one regular expression, leftmost
first, of four kinds: private keys between their lines of dashes, over as many
lines as they take; web tokens of three parts with dots; whole values of 6
characters or more that a word for a secret is assigned (quoted or unbroken,
letters, digits or marks); and maximal runs of 16 or more letters, digits and
``_+/-`` with a digit, with up to two equals signs at their end.  Their places
follow from the lengths of what lies between them.

*Features* of a candidate: length; shares of digits, upper-case letters, marks
and distinct characters; only hexadecimal or decimal digits; transitions between
character classes; plain words; consonant-vowel pairs; coverage by dictionary words; a known
issuer's prefix; a key's frame; words that speak for or against a secret, an
assignment and a quote right before it; words against it and a quote right
behind it; words of the path that speak against one.

*The forest* is Spark ML's, fitted in the JVM to labelled findings: a table
(path, before, token, after, label), by default ``labelled_findings``, which makes
them from a seed in the forms in which secrets and their look-alikes occur; no
public table has labelled real ones, own ones can be passed.

Defined cases.  Null text has no candidates, a null path counts as empty.
Repeated rows give their findings again; identifiers may be null.  An empty
table gives an empty result.  Very long texts and runs are scanned whole; a text
of n candidates takes time in proportion to its length and to n (blocks of
``BLOCK`` candidates are summed up once).  Extra columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import quoted, table

CLASS = "[A-Za-z0-9_+/-]"
KEY = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]*+(?:-----END [A-Z ]{0,40}PRIVATE KEY-----)?"
WEB_TOKEN = r"(?<![A-Za-z0-9_.-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"
NAMED = r"(?i:passw(?:or)?d|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential)[\"']?[ \t]{0,3}(?::=|=>|[=:])[ \t]{0,3}[\"']?"
VALUE = r"[^\s\"'<>,;(){}\[\]]{6,}+"
RUN = f"(?<!{CLASS})(?={CLASS}*[0-9]){CLASS}{{16,}}+={{0,2}}"
CANDIDATE = f"{KEY}|{WEB_TOKEN}|{NAMED}{VALUE}|{RUN}"
BLOCK = 256
N_LABELLED = 9000
TREES, DEPTH, SEED = 30, 7, 17
THRESHOLD = 0.5

FOR = r"(?i)(token|secret|passw(or)?d|pwd|api[_-]?key|access[_-]?key|auth|credential|bearer|private[_-]?key)[^A-Za-z0-9]{0,6}$"
AGAINST = r"(?i)(sha-?\d*|md5|commit|hash|checksum|digest|uuid|guid|revision|build|version|isbn|card|phone|page|order|invoice|ref)[^A-Za-z0-9]{0,6}$"
ASSIGNED = r"[=:]\s*[\"']?$"
QUOTED = r"[\"']$"
QUOTE_BEHIND = r"^[\"']"
ISSUED = r"^(AKIA[A-Z0-9]{16}|ASIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk_live_|rk_live_|xox[baprs]-|glpat-|npm_|eyJ)"
BEHIND_AGAINST = r"(?i)^[\"']?[^A-Za-z0-9]{0,3}(checksum|commit|hash|version|page|is required|is missing|example|placeholder|field)"
LOOSE_PATH = r"(?i)(test|example|sample|fixture|mock|doc)"
DICTIONARY = (
    "account", "admin", "alpha", "application", "beta", "build", "cache", "client", "cloud", "config", "content", "data", "default", "demo",
    "document", "example", "file", "folder", "home", "image", "index", "item", "library", "local", "login", "master", "message", "model", "module",
    "name", "network", "node", "number", "object", "order", "package", "page", "path", "placeholder", "product", "project", "python", "release",
    "report", "sample", "script", "server", "service", "session", "site", "source", "static", "string", "system", "table", "target", "test",
    "token", "update", "user", "value", "version", "video", "window", "world", "xxxx",
)

FEATURES = ("length", "digits", "uppers", "distinct", "hex", "decimal", "transitions", "syllables", "dictionary", "issued", "cue", "anticue", "assigned", "quoted", "loose_path", "marks", "framed", "behind_quote", "behind_against", "letters", "plain")


def features(token: Column, before: Column, path: Column, after: Column) -> dict[str, Column]:
    n = F.length(token)
    count = lambda p: F.regexp_count(token, F.lit(p))
    flag = lambda c, p: F.coalesce(c.rlike(p), F.lit(False)).cast("double")
    covered = n - F.length(F.regexp_replace(token, "(?i)(" + "|".join(DICTIONARY) + ")", ""))
    return {
        "length": n.cast("double"),
        "digits": count("[0-9]") / n,
        "uppers": count("[A-Z]") / n,
        "distinct": F.size(F.array_distinct(F.split(token, ""))) / F.least(n, F.lit(32)),
        "hex": flag(token, "^[0-9a-fA-F-]+$"),
        "decimal": flag(token, "^[0-9_+/-]+$"),
        "transitions": count("[a-z](?=[0-9A-Z])|[A-Z](?=[0-9a-z])|[0-9](?=[A-Za-z])|[_+/-](?=[A-Za-z0-9])") / n,
        "syllables": count("(?i)[bcdfghjklmnpqrstvwxyz][aeiou]") / n,
        "dictionary": covered / n,
        "issued": flag(token, ISSUED),
        "cue": flag(before, FOR),
        "anticue": flag(before, AGAINST),
        "assigned": flag(before, ASSIGNED),
        "quoted": flag(before, QUOTED),
        "loose_path": flag(path, LOOSE_PATH),
        "marks": count("[^A-Za-z0-9_+/=.-]") / n,
        "framed": flag(token, "^-----BEGIN "),
        "behind_quote": flag(after, QUOTE_BEHIND),
        "behind_against": flag(after, BEHIND_AGAINST),
        "letters": flag(token, "^[A-Za-z_-]+$"),
        "plain": flag(token, "^[A-Z]?[a-z]+(?:[_-][a-z]+)*$"),
    }


def labelled_findings(spark: SparkSession, n: int = N_LABELLED, seed: int = SEED) -> DataFrame:
    """path, before, token, after, label: ``n`` findings of known kind, the same for one seed."""
    h = lambda k: F.sha2(F.concat_ws(":", F.col("id").cast("string"), F.lit(f"{seed}:{k}")), 256)
    pick = lambda k, choices: F.element_at(F.array(*[F.lit(c) for c in choices]), (F.conv(F.substring(h(k), 1, 6), 16, 10).cast("int") % len(choices) + 1).cast("int"))
    span = lambda k, low, high: (F.conv(F.substring(h(k), 1, 6), 16, 10).cast("int") % (high - low + 1) + low).cast("int")
    hexa = h("x")
    wide = F.translate(F.base64(F.unhex(F.concat(h("y"), h("z")))), "=", "")
    base36 = F.upper(F.concat(F.lpad(F.conv(F.substring(h("u"), 1, 10), 16, 36), 8, "0"), F.lpad(F.conv(F.substring(h("v"), 1, 10), 16, 36), 8, "0")))
    digits = lambda k: F.translate(F.substring(h(k), 1, 40), "abcdef", "012345")
    word = lambda k: pick(k, [w for w in DICTIONARY if w != "xxxx"])
    joint = pick("s", ["_", "-", "/"])
    syllable = lambda k: pick(k, ["re", "con", "ti", "mer", "la", "ven", "do", "pli", "sta", "ru", "gen", "fo", "cha", "der", "nu", "ber"])
    named = ["token = \"", "secret: \"", "password=", "passwd: ", "api_key = '", "apikey=", "access_key: ", "auth_token=\"", "Bearer ", "credential = \"", "pwd=", "private_key: '"]
    prose = ["and then ", "of the ", "in it. ", "see ", "was ", "with ", "for "]
    ids = ["commit ", "sha256:", "sha1 ", "md5: ", "checksum=", "hash = \"", "uuid: ", "digest: ", "revision ", "build ", "version = \"", "order ", "invoice: "]
    kinds = [
        (F.substring(hexa, 1, 64).substr(F.lit(1), span("n", 16, 64)), pick("b", named), 1),
        (wide.substr(F.lit(1), span("n", 20, 64)), pick("b", named), 1),
        (F.concat(F.lit("AKIA"), base36), pick("b", [*named, *prose]), 1),
        (F.concat(pick("a", ["Tr0ub", "S3cure", "blue!", "qW", "Horse-", "x9#", "P@ss"]), F.substring(wide, 1, 4), pick("p", ["!", "&3", "#", "$9", "@x", "%", "*Z", "77"]), F.substring(wide, 5, 8).substr(F.lit(1), span("n", 0, 8))), pick("b", named), 1),
        (F.concat(F.substring(F.translate(wide, "+/0123456789", "abcdefghijkl"), 1, 40).substr(F.lit(1), span("n", 10, 40))), pick("b", named), 1),
        (F.concat(F.lit("eyJ"), F.translate(F.substring(wide, 1, 20), "+/", "-_"), F.lit("."), F.translate(F.substring(wide, 9, 30), "+/", "-_"), F.lit("."), F.translate(F.substring(wide, 20, 40), "+/", "-_")), pick("b", [*named, *prose]), 1),
        (F.concat(F.lit("-----BEGIN "), pick("p", ["", "RSA ", "EC ", "OPENSSH "]), F.lit("PRIVATE KEY-----\n"), F.substring(wide, 1, 64), F.lit("\n"), F.substring(wide, 10, 60), F.lit("=\n-----END PRIVATE KEY-----")), pick("b", [*named, *prose, "\n"]), 1),
        (F.concat(word("a"), pick("s", ["", "_", "-"]), pick("g", ["", "s", "ing", "ed"])), pick("b", named), 0),
        (F.concat(syllable("a"), syllable("c"), syllable("e"), pick("g", ["", "s", "ing", "ed", "ion"])), pick("b", named), 0),
        (F.concat(pick("p", ["your", "my", "the", "some", "$", "%", "env.", "os.", "get", "no"]), pick("s", ["_", "-", ""]), word("c"), pick("g", ["", "_here", "_value", "Name", "()"])), pick("b", named), 0),
        (F.concat(pick("p", ["ghp_", "gho_", "sk_live_", "glpat-", "npm_"]), F.translate(wide, "+/", "xY").substr(F.lit(1), span("n", 30, 40))), pick("b", [*named, *prose]), 1),
        (F.substring(hexa, 1, 64).substr(F.lit(1), F.element_at(F.array(F.lit(32), F.lit(40), F.lit(64)), span("n", 1, 3))), pick("b", ids), 0),
        (F.regexp_replace(F.substring(hexa, 1, 32), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), pick("b", [*ids, *prose, "id="]), 0),
        (digits("d").substr(F.lit(1), span("n", 16, 19)), pick("b", [*prose, "card ", "number: ", "+"]), 0),
        (F.concat(word("a"), joint, word("c"), joint, word("e"), joint, digits("d").substr(F.lit(1), span("n", 1, 4))), pick("b", [*prose, *named]), 0),
        (F.concat(F.lit("/"), word("a"), F.lit("/"), word("c"), span("n", 1, 99).cast("string"), F.lit("/"), word("e"), F.lit("-"), word("g")), pick("b", [*prose, "path=", "\""]), 0),
        (F.concat(F.lit("2024-"), span("m", 10, 12).cast("string"), F.lit("-"), span("n", 10, 28).cast("string"), F.lit("_"), word("a"), F.lit("_"), word("c")), pick("b", prose), 0),
        (F.concat(F.repeat(pick("s", ["x", "X", "0", "a"]), 16), span("n", 1, 999).cast("string")), pick("b", [*named, *prose]), 0),
        (F.concat(word("a"), F.lit("_"), pick("p", ["placeholder", "example", "sample", "test"]), F.lit("_"), word("c"), span("n", 1, 9999).cast("string")), pick("b", named), 0),
    ]
    kind = F.col("id") % len(kinds)
    choose = lambda k: F.coalesce(*[F.when(kind == i, x[k]) for i, x in enumerate(kinds)])
    token, before, label = choose(0), choose(1), F.element_at(F.array(*[F.lit(x[2]) for x in kinds]), (kind + 1).cast("int"))
    # a quote behind closes one before; what follows says little of a secret, something of what is none
    quote = F.regexp_extract(before, QUOTED, 0)
    after = F.concat(quote, F.when(label == 1, pick("f", ["", "\n", ",", " and", ";", " # ours", ") "])).otherwise(pick("f", ["", "\n", ",", " and", " checksum", " is required", " page", ") "])))
    return spark.range(0, n, 1, 1).select(pick("path", ["src/main", "web", "notes", "tests/data", "docs", "app/config"]).alias("path"), before.alias("before"), token.alias("token"), after.alias("after"), label.alias("label"))


def train(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> RandomForestClassificationModel:
    """The forest over findings (path, before, token, after, label)."""
    rows = labelled.select(F.col("label").cast("double").alias("label"), *[c.alias(k) for k, c in features(F.col("token"), F.col("before"), F.col("path"), F.col("after")).items()])
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.8, featureSubsetStrategy="sqrt").fit(data)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often a lambda within asks for it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _starts(gaps: Column, found: Column) -> Column:
    """Where each of ``found`` starts, ``gaps`` being what lies before and between them: sums of whole blocks, and of the rest of a block."""
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)
    blocks = F.sequence(F.lit(0), F.floor(F.size(found) / BLOCK).cast("int"))
    block = lambda i: F.floor(i / BLOCK).cast("int")
    steps = F.transform(found, lambda t, i: (F.length(F.get(gaps, i)) + F.length(t)).cast("long"))
    place = lambda steps, before: F.transform(found, lambda t, i: F.get(before, block(i)) + total(F.slice(steps, block(i) * BLOCK + 1, i % BLOCK)) + F.length(F.get(gaps, i)))
    sums = lambda steps: F.transform(blocks, lambda b: total(F.slice(steps, b * BLOCK + 1, BLOCK)))
    return _let(steps, lambda steps: _let(sums(steps), lambda sums: _let(F.transform(blocks, lambda b: total(F.slice(sums, F.lit(1), b))), lambda before: place(steps, before))))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """id, path, start, end (code points, end exclusive), token, before, after (up to 40 characters)."""
    path = F.lit("") if path_col is None else F.coalesce(quoted(path_col).cast("string"), F.lit(""))
    text = quoted(text_col)

    def each(found: Column, gaps: Column, starts: Column) -> Column:
        # only what belongs to a candidate goes on with it, no array of the text's others
        return F.transform(found, lambda m, i: F.struct(F.get(starts, i).alias("at"), m.alias("found"), F.right(F.get(gaps, i), F.lit(40)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(40)).alias("after")))

    one = _let(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), lambda found: F.when(F.size(found) > 0, _let(F.split(text, CANDIDATE, -1), lambda gaps: _let(_starts(gaps, found), lambda starts: each(found, gaps, starts)))))
    rows = docs.select(quoted(id_col).alias("id"), path.alias("path"), one.alias("all"))
    rows = rows.select("id", "path", F.explode("all").alias("c")).select("id", "path", "c.*")
    name = F.regexp_extract("found", f"^{NAMED}(?={VALUE})", 0)  # the secret's name is no part of it
    rows = rows.withColumns({"start": (F.col("at") + F.length(name)).cast("long"), "token": F.substring(F.col("found"), F.length(name) + 1, F.length("found")), "before": F.right(F.concat("before", name), F.lit(40))})
    return rows.select("id", "path", "start", (F.col("start") + F.length("token")).alias("end"), "token", "before", "after")


def scan(docs: DataFrame, model: RandomForestClassificationModel, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", threshold: float = THRESHOLD) -> DataFrame:
    """The candidates with score (0 to 1) and secret (score at or above ``threshold``)."""
    rows = candidates(docs, id_col, text_col, path_col)
    rows = rows.select("*", *[c.alias(k) for k, c in features(F.col("token"), F.col("before"), F.col("path"), F.col("after")).items()])
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    score = F.get(vector_to_array("probability"), F.lit(1))
    return model.transform(data).select("id", "path", "start", "end", "token", "before", "after", score.alias("score"), (score >= threshold).alias("secret"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All candidates of all documents; the tokens themselves are not given out, but their SHA-256."""
    model = train(labelled_findings(spark))
    out = scan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), model)
    return out.select(F.col("id").alias("doc_id"), "start", "end", F.sha2(F.col("token").cast("binary"), 256).alias("token_sha256"), F.round("score", 6).alias("score"), "secret")
