"""Secret scan with multipart credential linking.

Patterns give parts of three roles: access identifiers, secrets and endpoints. Strong parts (the base kinds) are
always reported. Weak parts - short or named identifiers, short assigned or bare mixed tokens, addresses - are
reported only where an interval join finds their complement in one of their scopes: an identifier needs a secret, a
secret needs an identifier or an endpoint, an endpoint needs both.

Scopes are intervals of the text: paragraphs (between blank lines), sections (from a line ``[name]`` to the next one), and
objects in braces, of which those count that are the innermost one around a part; so parts of two objects beside each
other do not meet, but an object and what it encloses do. The join asks every scope for the roles inside it and
marks the parts of the range, so it takes a step per scope and per part and forms no pairs. Parts belong to one text, so
nothing is shuffled.

Parts never complement themselves: of overlapping parts the first of strong, named secret, endpoint, bare token, identifier
stays (base spans all do), so an address is no secret of its own, and one assignment has one role. A named or
short value has to look made up: words of prose are no secrets.

Defined cases: null and empty texts have no spans; equal spans of one kind are reported once; overlapping spans of
different kinds all are; other columns pass through, but one with the name of the added one is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.session import others

MASK = "<secret>"
KINDS = ("assign", "access", "hex", "named_id", "weak_secret", "endpoint")
BASE_KINDS = KINDS[:3]

_ANY = re.IGNORECASE | re.ASCII
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _ANY)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
NAMED_ID = re.compile(r"""(?<![A-Za-z0-9])(access_?key(?:_?id)?|client_?id|user(?:_?name)?|login|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""", _ANY)
NAMED_SECRET = re.compile(r"""(?<![A-Za-z0-9])(pwd|pass|private_?key|secret_?access_?key|credential)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{6,})""", _ANY)
BARE_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
ENDPOINT = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s\"'<>]+")
PARAGRAPH = re.compile(r"\n[ \t\r]*\n")
SECTION = re.compile(r"^[ \t]*\[[^\[\]\n]+\][ \t]*\r?$", re.M)
BRACE = re.compile(r"[{}]")
SEPARATOR = re.compile(r"[:=]")
SHORT_ASSIGN, LONG_ASSIGN, LONG_ACCESS = 6, 12, 18

Span = tuple[str, int, int]


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Strong spans, and matches of the same patterns that are too short to be strong."""
    strong, short = [], []
    if SEPARATOR.search(text):
        for m in ASSIGN.finditer(text):
            size = m.end(2) - m.start(2)
            if size >= LONG_ASSIGN:
                strong.append(("assign", m.start(), m.end()))
            elif size >= SHORT_ASSIGN and _made_up(m[2]):
                short.append(("weak_secret", m.start(), m.end()))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            long = m.end() - m.start() >= LONG_ACCESS
            (strong if long else short).append(("access" if long else "named_id", m.start(), m.end()))
    strong.extend(("hex", m.start(), m.end()) for m in HEX.finditer(text))
    return strong, short


def _mixed(token: str) -> bool:
    """A token with lower case, upper case and digits."""
    return any(c.islower() for c in token) and any(c.isupper() for c in token) and any(c.isdigit() for c in token)


def _made_up(value: str) -> bool:
    """A value that is no word: digits, signs inside, or upper case behind the first letter of a mixed one."""
    inner = value.rstrip(".=-_/+")
    return any(not c.isalpha() for c in inner) or not (inner.islower() or inner.isupper() or inner.istitle())


def weak_parts(text: str) -> list[Span]:
    """Candidates that mean nothing alone, in the order of their precedence."""
    out: list[Span] = []
    if SEPARATOR.search(text):
        out.extend(("weak_secret", m.start(), m.end()) for m in NAMED_SECRET.finditer(text) if _made_up(m[2]))
        if "://" in text:
            out.extend(("endpoint", m.start(), m.end()) for m in ENDPOINT.finditer(text))
    out.extend(("weak_secret", m.start(), m.end()) for m in BARE_TOKEN.finditer(text) if _mixed(m.group()))
    if SEPARATOR.search(text):
        out.extend(("named_id", m.start(), m.end()) for m in NAMED_ID.finditer(text))
    return out


ROLE = {"access": "id", "named_id": "id", "assign": "secret", "hex": "secret", "weak_secret": "secret", "endpoint": "endpoint"}
ROLES = ("id", "secret", "endpoint")


def apart(strong: list[Span], weak: list[Span]) -> list[Span]:
    """The weak parts that overlap no strong one and none of higher precedence."""
    taken: list[tuple[int, int]] = []  # disjoint, by start
    for _, start, stop in sorted(strong, key=lambda span: span[1:]):
        if taken and start < taken[-1][1]:
            taken[-1] = taken[-1][0], max(taken[-1][1], stop)
        else:
            taken.append((start, stop))
    kept = []
    for span in weak:
        place = bisect_left(taken, span[1:])
        if (place == 0 or taken[place - 1][1] <= span[1]) and (place == len(taken) or taken[place][0] >= span[2]):
            taken.insert(place, span[1:])
            kept.append(span)
    return kept


def scopes(text: str, parts: list[Span]) -> set[tuple[int, int]]:
    """Intervals in which parts meet: paragraphs, sections, and the innermost object around each part."""
    found: set[tuple[int, int]] = set()
    for marks in (PARAGRAPH, SECTION):
        breaks = [0, *[m.start() for m in marks.finditer(text)], len(text)]
        if len(breaks) > 2 or marks is PARAGRAPH:
            found.update((breaks[i - 1], breaks[i]) for i in {bisect_right(breaks, start) for _, start, _ in parts} if i < len(breaks))
    if "{" in text:
        objects, opened = [], []
        for m in BRACE.finditer(text):
            if m[0] == "{":
                opened.append(m.start())
            elif opened:
                objects.append((opened.pop(), m.end()))
        objects.sort()
        around: list[tuple[int, int]] = []
        at = 0
        for _, start, _ in sorted(parts, key=lambda span: span[1]):
            while at < len(objects) and objects[at][0] <= start:
                around.append(objects[at])
                at += 1
            # Objects that ended before stay in the list only while a later one covers them.
            while around and around[-1][1] <= start:
                around.pop()
            if around:
                found.add(around[-1])
    return found


def linked(text: str, strong: list[Span], weak: list[Span]) -> list[Span]:
    """Weak spans whose complementary parts lie in one of their scopes."""
    weak = apart(strong, weak)
    parts = sorted({*strong, *weak}, key=lambda span: span[1:])
    if not weak or len({ROLE[kind] for kind, _, _ in parts}) < 2:
        return []
    starts = [start for _, start, _ in parts]
    before = {role: [0, *accumulate(ROLE[kind] == role for kind, _, _ in parts)] for role in ROLES}
    marks = {role: [0] * (len(parts) + 1) for role in ROLES}
    for begin, end in scopes(text, parts):
        low, high = bisect_left(starts, begin), bisect_left(starts, end)
        has = {role: before[role][high] > before[role][low] for role in ROLES}
        needs = {"id": has["secret"], "secret": has["id"] or has["endpoint"], "endpoint": has["id"] and has["secret"]}
        for role, met in needs.items():
            marks[role][low] += met
            marks[role][high] -= met
    met = {role: list(accumulate(marks[role])) for role in ROLES}
    reported = set(weak)
    return [span for i, span in enumerate(parts) if span in reported and met[ROLE[span[0]]][i]]


def _order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def text_spans(text: str | None) -> list[Span]:
    """All reported spans of a text by start, then kind."""
    if not text:
        return []
    strong, short = base_spans(text)
    weak = short + weak_parts(text)
    return sorted({*strong, *linked(text, strong, weak)}, key=_order)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every run of overlapping spans replaced by the mask."""
    out, at, stop = [], 0, -1
    for _, a, b in sorted(spans, key=_order):
        if a >= stop:
            out += [text[at:a], MASK]
        stop = at = max(stop, b)
    return "".join([*out, text[at:]])


SPAN_TYPE = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))


def find_secrets(docs: DataFrame, text_column: str = "text", spans_column: str = "secret_spans") -> DataFrame:
    """The documents with one more column, their reported spans in code points."""
    docs = others(docs, spans_column)
    schema = T.StructType([*docs.schema.fields, T.StructField(spans_column, SPAN_TYPE)])
    names = [*docs.columns, spans_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"kind": k, "start": a, "stop": b} for k, a, b in text_spans(t)] for t in batch.column(text_column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, _ARROW_SPANS)], names)

    return docs.mapInArrow(run, schema)


def redact_secrets(docs: DataFrame) -> DataFrame:
    """The documents with every reported span masked and ``n_chars`` following the text, where there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t and redacted(t, text_spans(t)) for t in batch.column("text").to_pylist()]
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns["text"] = pa.array(texts, batch.schema.field("text").type)
            if "n_chars" in columns:
                lengths = [n if t is None else len(t) for n, t in zip(columns["n_chars"].to_pylist(), texts, strict=True)]
                columns["n_chars"] = pa.array(lengths, batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(run, docs.schema)




def secret_report(docs: DataFrame) -> DataFrame:
    """Per document: base spans by kind, a digest of them, and all spans as text."""
    found = find_secrets(docs.select("doc_id", "text"))
    named = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("secret_spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("secret_spans", lambda x: x["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(named(base), 256).alias("base_sha256"),
        named(F.col("secret_spans")).alias("spans"),
    )
