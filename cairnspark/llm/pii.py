"""Personal data by anchor expansion.

One Aho-Corasick automaton runs over each whole text and stops at anchors: at
signs, plus signs, digits, ``://`` of schemes, and cues of identifiers such as
"account" or "iban".  At an anchor, deterministic parsers look at the
surroundings only: an email grows to both sides of its at sign, an address or a
number to the right of its first digit, an account identifier to the right of
its cue; each is validated (part sizes, digit counts, Luhn, ISO 7064) and
dropped if it fails.  Per kind, findings are leftmost and do not overlap: an
anchor inside what was matched before, valid or not, is passed over.

Kinds: ``email``, ``ip``, ``card``, ``phone`` (the base), ``login`` (user and
password within a URL) and ``account`` (an identifier behind a cue).  Offsets
are in code points, end exclusive.

Defined cases.  Null text counts as empty: no findings, unchanged by
``redact``.  Rows are taken one by one: repeated rows, null identifiers and
extra columns, whatever their names, come through as they are.  An empty table
gives an empty result.  A very long text is scanned whole, in time linear in
its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, map_arrow, table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "login", "account")

#: Words that announce an identifier of a person or their account.
CUES = ("account", "acct", "iban", "konto", "kontonummer", "compte", "cuenta", "passport", "ssn", "social security")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# what may stand at an anchor; all are tried at one place, never searched
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGITS = re.compile(r"[0-9]+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])+")
DIALLED = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOGIN = re.compile(r"[A-Za-z0-9._~%!$&'*+,;=-]++:[^\s:@/?#]++@[A-Za-z0-9.-]++")
BEHIND_CUE = re.compile(r"(?:[ \t]?(?:no|nr|number|nummer|num|id|numéro|número)\b\.?)?[ \t]?[:#=]?[ \t]?(?=[A-Za-z0-9])", re.IGNORECASE)
IDENTIFIER = re.compile(r"[A-Z]{0,4}[0-9](?:[ -]?[A-Z0-9]){5,33}(?![A-Za-z0-9])")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if k % 2:
            v = 2 * v - 9 * (v > 4)
        total += v
    return total % 10 == 0


def iban_valid(s: str) -> bool:
    s = s[4:] + s[:4]
    return int("".join(str(int(c, 36)) for c in s)) % 97 == 1


def _part(p: str) -> bool:
    p = p.lstrip("0")
    return len(p) <= 3 and int(p or "0") <= 255


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for d in "0123456789":
        a.add_word(d, ("digit", 1))
    a.add_word("@", ("at", 1))
    a.add_word("+", ("plus", 1))
    a.add_word("://", ("scheme", 3))
    for cue in CUES:
        for form in {cue, cue.capitalize(), cue.upper()}:
            a.add_word(form, ("cue", len(form)))
    a.make_automaton()
    return a


class Finder:
    """find(text): the findings as (kind, start, end), in the order of KINDS, then by start."""

    def __init__(self) -> None:
        self.automaton = automaton()

    def find(self, text: str) -> list[tuple[str, int, int]]:
        found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
        done = dict.fromkeys(KINDS, 0)  # up to where a kind has matched
        for last, (what, n) in self.automaton.iter(text):
            at = last - n + 1
            if what == "digit":
                if at >= done["ip"]:
                    if m := DOTTED.match(text, at):
                        if all(map(_part, m[0].split("."))):
                            found["ip"].append(m.span())
                        done["ip"] = m.end()
                    else:  # nor can a later digit of the same run begin one
                        done["ip"] = DIGITS.match(text, at).end()
                if at >= done["card"]:
                    if m := GROUPED.match(text, at):
                        digits = m[0].replace(" ", "").replace("-", "")
                        if 16 <= len(digits) <= 19 and luhn(digits):
                            found["card"].append(m.span())
                        done["card"] = m.end()
            elif what == "at":
                start = at
                while start > done["email"] and text[start - 1] in LOCAL:
                    start -= 1
                if start < at and (m := DOMAIN.match(text, at + 1)):
                    found["email"].append((start, m.end()))
                    done["email"] = m.end()
            elif what == "plus":
                if at >= done["phone"] and (m := DIALLED.match(text, at)):
                    if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                        found["phone"].append(m.span())
                    done["phone"] = m.end()
            elif what == "scheme":
                if at >= done["login"] and at and text[at - 1].isalpha() and (m := LOGIN.match(text, last + 1)):
                    found["login"].append(m.span())
                    done["login"] = m.end()
            elif at >= done["account"] and not (at and text[at - 1].isalnum()) and not text[last + 1 : last + 2].isalpha():
                gap = BEHIND_CUE.match(text, last + 1)
                if gap and (m := IDENTIFIER.match(text, gap.end())):
                    plain = re.sub(r"[ -]", "", m[0])
                    if re.match(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$", plain):
                        good = iban_valid(plain)
                    else:
                        good = sum(map(str.isdigit, plain)) >= 6
                    if good:
                        found["account"].append(m.span())
                    done["account"] = m.end()
        return [(k, a, z) for k in KINDS for a, z in found[k]]


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def find_pii(docs: DataFrame, text_col: str = "text", out: str = "pii") -> DataFrame:
    """The input's columns and its findings as ``out``, with underscores added if the input has a column of that name."""
    out, rows = fresh(out, docs.columns), docs
    text_at = docs.columns.index(text_col)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for b in batches:
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in finder.find(t.as_py() or "")] for t in b.column(text_at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, kind)], [*b.schema.names, out])

    return map_arrow(rows, scan, T.StructType([*rows.schema.fields, T.StructField(out, SPANS)]))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The input's columns; in the text, each finding is replaced by its kind in angle brackets.  Of findings that overlap, the one that starts first counts (of several, the longest)."""
    rows = docs
    text_at = docs.columns.index(text_col)

    def clean(finder: Finder, text: str | None) -> str | None:
        if text is None:
            return None
        out, at = [], 0
        for kind, s, e in sorted(finder.find(text), key=lambda f: (f[1], -f[2])):
            if s >= at:
                out += [text[at:s], f"<{kind}>"]
                at = e
        return "".join([*out, text[at:]])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for b in batches:
            texts = pa.array([clean(finder, t.as_py()) for t in b.column(text_at)], b.schema.field(text_at).type)
            yield b.set_column(text_at, b.schema.field(text_at), texts)

    return map_arrow(rows, scan, rows.schema)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = lambda kind: F.size(F.filter("pii", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")
    said = lambda spans: F.array_join(F.transform(spans, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")
    base = said(F.filter("pii", lambda f: f["kind"].isin(*BASE_KINDS)))
    return out.select("doc_id", *[n(k) for k in BASE_KINDS], F.sha2(base.cast("binary"), 256).alias("base_sha256"), said(F.col("pii")).alias("spans"))
