"""PII by anchor expansion.

An Aho-Corasick automaton finds anchors (at-signs, digit pairs, ``digit.``, ``+digit``, URL schemes,
identifier cues) in one pass over a text; a local parser then expands each anchor to its boundaries
and validates what it found.  Nothing else of the text is looked at, and every text is scanned whole.

Kinds, in this order: ``email ip card phone`` (base) and ``account secret url`` (added: account and
IBAN numbers after their cue, ``key = value`` secrets, URLs that carry a user name).
Offsets are code points, the end is exclusive.  Spans of one kind do not overlap.

Null and empty texts have no spans; repeated rows give repeated results; columns besides ``doc_id``
and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "account", "secret", "url")
# fixed values: cues of identifiers
ACCOUNT_CUES = ("account", "acct", "iban", "ssn", "passport")
SECRET_CUES = ("password", "passwd", "secret", "token", "api_key", "apikey")
SCHEMES = ("http://", "https://", "ftp://")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: No account is longer than 34 letters and digits.  Blanks are not given back, so no run of them is read twice.
_ACCOUNT = re.compile(r"(?:[ \t]*+(?:no\.?|number|nr\.?|#))?[ \t]*+[:=#]?[ \t]*+([A-Za-z]{0,4}[0-9](?:[ -]?[A-Za-z0-9]){0,40})", re.I | re.ASCII)
_SECRET = re.compile(r"[ \t]*+[:=][ \t]*+[\"']?([A-Za-z0-9_+/=.-]{6,}+)")
_USERINFO = re.compile(r"[^\s/?#@]+@[^\s/?#]+[^\s]*")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban(s: str) -> bool:
    """Country letters, 15 to 34 characters, remainder 1 of 97."""
    if not (15 <= len(s) <= 34 and s[:2].isalpha() and s[2:4].isdigit()):
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


@cache
def _automaton():
    import ahocorasick
    words: dict[str, list[str]] = {}
    add = lambda w, kind: words.setdefault(w, []).append(kind)
    digits = "0123456789"
    add("@", "email")
    for x in digits:
        add(f"{x}.", "ip")
        add(f"+{x}", "phone")
        for sep in ("", " ", "-"):
            for y in digits:
                add(f"{x}{sep}{y}", "card")
    for cues, kind in ((ACCOUNT_CUES, "account"), (SECRET_CUES, "secret"), (SCHEMES, "url")):
        for w in cues:
            for v in {w, w.upper(), w.capitalize()}:
                add(v, kind)
    a = ahocorasick.Automaton()
    for w, kinds in words.items():
        a.add_word(w, (len(w), tuple(kinds)))
    a.make_automaton()
    return a


def _email(text: str, at: int, done: int):
    start = at
    while start > done and text[start - 1] in _LOCAL:
        start -= 1
    m = _DOMAIN.match(text, at + 1) if start < at else None
    return ([(start, m.end())], m.end()) if m else ([], done)


def _ip(text: str, at: int, done: int):
    start = at
    while start > done and text[start - 1] in "0123456789":
        start -= 1
    m = _DOTTED.match(text, start)
    if not m:
        return [], done
    found, p, parts = [], start, m[0].split(".")
    for k in range(0, len(parts) - 3, 4):
        four = parts[k:k + 4]
        end = p + sum(map(len, four)) + 3
        if all(len(y := x.lstrip("0")) <= 3 and int(y or "0") <= 255 for x in four):
            found.append((p, end))
        p = end + 1
    return found, m.end()


def _card(text: str, at: int, done: int):
    m = _DIGITS.match(text, at)
    digits = m[0].replace(" ", "").replace("-", "")
    return [m.span()] if 16 <= len(digits) <= 19 and luhn(digits) else [], m.end()


def _phone(text: str, at: int, done: int):
    m = _PHONE.match(text, at)
    if not m:
        return [], done
    return [m.span()] if 8 <= sum(c in "0123456789" for c in m[0]) <= 15 else [], m.end()


def _account(text: str, at: int, done: int):
    m = _ACCOUNT.match(text, at)
    if not m:
        return [], done
    body = re.sub("[ -]", "", m[1])
    end = m.end(1)
    if body[:2].isalpha():  # an IBAN may be followed by more words: the longest valid head counts
        if not body[2:4].isdigit():
            return [], done
        size, stops = 0, []
        for stop in range(m.start(1), end):
            size += text[stop] not in " -"
            if 15 <= size <= 34 and text[stop] not in " -" and (stop + 1 == len(text) or not text[stop + 1].isalnum()):
                stops.append((stop + 1, size))
        for stop, size in reversed(stops):
            if iban(body[:size].upper()):
                return [(m.start(1), stop)], stop
        return [], done
    lead = re.match(r"[0-9](?:[ -]?[0-9])*", m[1])
    whole = lead and (lead.end() == len(m[1]) or not m[1][lead.end()].isalnum())
    ok = whole and 6 <= len(re.sub("[ -]", "", lead[0])) <= 18
    return ([(m.start(1), m.start(1) + lead.end())], end) if ok else ([], done)


def _secret(text: str, at: int, done: int):
    m = _SECRET.match(text, at)
    if not m:
        return [], done
    # a value without digits has none after its inner cues either: it is not read again
    return ([m.span(1)] if any(c in "0123456789" for c in m[1]) else []), m.end()


def _url(text: str, at: int, done: int):
    m = _USERINFO.match(text, at)
    start = text.rfind("://", 0, at)
    while start > done and text[start - 1].isalpha():
        start -= 1
    return ([(start, m.end())], m.end()) if m else ([], done)


#: kind -> (parser, whether it begins at the anchor's end)
_PARSERS = {"email": (_email, 0), "ip": (_ip, 0), "card": (_card, 0), "phone": (_phone, 0),
            "account": (_account, 1), "secret": (_secret, 1), "url": (_url, 1)}


def find(text: str | None) -> list[tuple[str, int, int]]:
    """All (kind, start, end), by kind as in ``KINDS``, then start."""
    if not text:
        return []
    spans: dict[str, list[tuple[int, int]]] = {}
    done = dict.fromkeys(KINDS, 0)
    for last, (size, kinds) in _automaton().iter(text):
        for kind in kinds:
            parse, after = _PARSERS[kind]
            at = last + 1 if after else last + 1 - size
            if at < done[kind]:
                continue
            found, done[kind] = parse(text, at, done[kind])
            if found:
                spans.setdefault(kind, []).extend(found)
    return [(k, s, e) for k in KINDS for s, e in spans.get(k, ())]


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """Each span, or run of overlapping spans, becomes ``[KIND]`` of its first kind."""
    if not spans:
        return text
    out, p = [], 0
    merged: list[list] = []
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([kind, s, e])
    for kind, s, e in merged:
        out += [text[p:s], f"[{kind.upper()}]"]
        p = e
    return "".join([*out, text[p:]])


SPAN = "array<struct<kind:string,start:int,end:int>>"


def detect(docs: DataFrame, with_redacted: bool = False) -> DataFrame:
    """(doc_id, spans[, redacted]) for every row; no shuffle, one batch of texts in memory."""
    fields = [docs.schema["doc_id"].simpleString().replace(":", " ", 1), f"spans {SPAN}"]
    fields += ["redacted string"] * with_redacted
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            found = [find(t) for t in texts]
            cols = {"doc_id": b.column(0), "spans": pa.array([[dict(zip(("kind", "start", "end"), s)) for s in x] for x in found], kind)}
            if with_redacted:
                cols["redacted"] = pa.array([redact(t, x) for t, x in zip(texts, found)], pa.string())
            yield pa.RecordBatch.from_pydict(cols)

    return docs.select("doc_id", "text").mapInArrow(run, ", ".join(fields))


def report(docs: DataFrame) -> DataFrame:
    """Counts by base kind, a digest of the base spans, and all spans as text."""
    d = detect(docs)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    n = [count(kind) for kind in BASE]
    return d.select("doc_id", *n, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced in ``text`` and ``n_chars`` counted anew; no row goes."""
    cols = docs.columns
    at, n = cols.index("text"), cols.index("n_chars") if "n_chars" in cols else None
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [redact(t, find(t)) for t in b.column(at).to_pylist()]
            out = list(b.columns)
            out[at] = pa.array(texts, pa.string())
            if n is not None:
                old = b.column(n)
                out[n] = pa.array([o if t is None else len(t) for t, o in zip(texts, old.to_pylist())], old.type)
            yield pa.RecordBatch.from_arrays(out, names=cols)

    return docs.mapInArrow(run, schema)


def digest(spans: list[tuple[str, int, int]]) -> str:
    """The digest that ``report`` gives, in plain Python (tests)."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans if k in BASE).encode()).hexdigest()
