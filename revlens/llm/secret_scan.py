"""Secrets in texts: fixed patterns, and an assignment-aware lexer.

The lexer reads source and configuration syntax (``name = "x"``, ``name: x``, ``"name": "x"``,
``NAME=x``, ``f(name="x")``, ``name => 'x'``, ``<name>x</name>``) into pairs of a target name and
literals. Names that hold a literal are constants, and a target that is given a constant, or a
sum of them, gets the constants' literals. A literal may stand on the line after its separator, and
keys that are wrapped over lines count as one: in quotes, triple quotes, blocks of YAML, and private
keys in PEM armor, whose label is their name. Behind a scheme (``Bearer x``) only the token counts. Each literal is scored by how sensitive its target's
name is and by how much it looks like a key rather than a placeholder or prose. Literals that
reach ``LEAST_SCORE`` are spans of the kind ``named``; the fixed kinds are always kept.

NULL and empty texts have no spans. Constants hold within one text, from where they are set.
Spans are in code points, ordered by begin, then kind. Repeated rows get equal spans. Only the
id and text columns are read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.frames import batch_of, chunks

# The patterns of the three base kinds, and the order of kinds.
ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "named")
STEMS = ("password", "passwd", "secret", "token", "api")

# How much a word in a target's name says that its value is secret.
WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "auth": 0.6, "authorization": 0.7, "bearer": 0.8, "private": 0.6, "signing": 0.6,
    "encryption": 0.6, "access": 0.5, "key": 0.5, "api": 0.4, "pass": 0.7, "salt": 0.6, "session": 0.4, "cookie": 0.4, "dsn": 0.6,
}
SENSITIVE = re.compile("|".join(sorted(WEIGHTS, key=len, reverse=True)))
LEAST_SCORE = 0.5
LEAST_LENGTH = 6
SHORT = 512  # literals up to here are looked at one by one, though they have one end
LONGEST_NAME = 4096  # of a constant that an unquoted value may be
SPACE = re.compile(r"\s")
PLACEHOLDER_FIRST = re.compile(r"your|my|change[_-]?me|example|sample", re.I)
PLACEHOLDER = re.compile(
    r"^(?:x+|\*+|\.+|-+|(?:your|my|change[_-]?me|example|sample)(?:[^A-Za-z0-9][^0-9]*)?|test|none|null|nil|true|false|todo"
    r"|<.*>|\$\{.*\}|\$\(.*\)|%\(.*\)s|\{\{.*\}\})$", re.I
)

STRINGS = {'"': r'''"(?:[^"\\\n]|\\.)*"''', "'": r"""'(?:[^'\\\n]|\\.)*'""", "`": r"`[^`\n]*`"}
REST = (
    r"""(?P<tag><(?P<tagname>[A-Za-z_][\w.-]*)>(?P<tagtext>[^<>\n]+)</)"""
    r"""|(?P<name>[A-Za-z_$][\w$]*(?:[.-][A-Za-z_$][\w$]*)*)"""
    r"""|(?P<set>:=|=>|==|!=|<=|>=|=|:)"""
    r"""|(?P<plus>\+)|(?P<bare>[0-9][^\s,;)}\]"'`]*)|(?P<other>\S)"""
)
SCHEME = r"(?i:bearer|basic|token|apikey|jwt|negotiate)[ \t]+"
SCHEME_FIRST = re.compile(SCHEME)
# Where an unquoted value ends, and what may follow it.
STOP = re.compile(r"""[\s"'`,;(){}\[\]<>]""")
BLANKS = re.compile(r"[ \t]*")
SEPARATES = re.compile(r"[ \t]*[:=]")
NOTHING_MORE = re.compile(r"\s*$")
SCHEMED = re.compile(rf"[ \t]*{SCHEME}([^\s{{$<%]\S*)[ \t]*$")
HEADER = re.compile(rf"[ \t]*([A-Za-z][\w-]*):[ \t]*(?:{SCHEME})?([^\s{{$<%]\S*)[ \t]*$")
# Quoted keys without blanks but line ends, possibly in triple quotes; the next line's only word; a block of YAML.
WRAPPED = re.compile(r"""(?P<q>\"{3}|'{3}|["'`])\s*(?P<key>[^\s"'`]+(?:[ \t]*\r?\n[ \t]*[^\s"'`]+)*)\s*(?P=q)""")
ALONE = re.compile(r"""[ \t]*([^\s"'`,;(){}\[\]<>=:#-][^\s"'`,;(){}\[\]<>=:]*=*)[ \t]*$""")
BLOCK_MARK = re.compile(r"[ \t]*[|>][-+0-9]*[ \t]*(?:#.*)?$")
PEM = re.compile(r"-----BEGIN (?P<label>[A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?)-----(?:(?!-----)[\s\S])*(?:-----END (?P=label)-----)?")
ARMOR = re.compile(r"-----(?:BEGIN|END) [A-Z0-9 ]+-----|^[A-Z][\w-]*: .*$", re.M)


@lru_cache(maxsize=4096)
def name_score(name: str) -> float:
    """The strongest word of a name, a little more for each further one, at most 1."""
    split = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()
    found = sorted((WEIGHTS[w] for w in re.split(r"[^a-z0-9]+", split) if w in WEIGHTS), reverse=True)
    return min(1.0, found[0] + 0.3 * sum(found[1:])) if found else 0.0


def _looks(size: int, counts: Counter) -> float:
    """How much a text of these characters looks like a key, up to 1."""
    entropy = -sum(n / size * math.log2(n / size) for n in counts.values() if n)
    kinds = len({_kind_of(c) for c, n in counts.items() if n})
    return min(1.0, 0.25 + entropy / 6 + 0.1 * kinds)


def _kind_of(c: str) -> int:
    return 0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3


def literal_score(value: str) -> float:
    """0 for short, prose-like or placeholder values, up to 1 for long random ones."""
    value = ARMOR.sub("", value) if "-----BEGIN" in value else value
    value = "".join(part.strip() for part in value.split("\n"))
    if len(value) < LEAST_LENGTH or PLACEHOLDER.match(value) or SPACE.search(value):
        return 0.0
    return _looks(len(value), Counter(value))


def _scores_of_tails(text: str, begins: list[int], end: int) -> dict[int, float]:
    """``literal_score`` of the unquoted values that begin at ascending places and end at one.

    Characters are counted once for all of them: each value is the end of the one before.
    """
    out, counts, at = {}, Counter(text[begins[0] : end]), begins[0]
    for begin in begins:
        counts.subtract(text[at:begin])
        at, size = begin, end - begin
        if size < LEAST_LENGTH:
            out[begin] = 0.0
        elif size <= SHORT:
            out[begin] = literal_score(text[begin:end])
        else:
            first = PLACEHOLDER_FIRST.match(text, begin)
            letters_only = first and not text[first.end()].isalnum() and not any(counts[d] for d in "0123456789")
            out[begin] = 0.0 if letters_only else _looks(size, counts)
    return out


class _Given:
    """What a name is given in one place: a literal, and what other names held then.

    ``best`` is the highest score of this name and of all that were given its value, with that name.
    """

    __slots__ = ("best", "parts", "place")

    def __init__(self, name: str, place: tuple[int, int] | None, parts: list[_Given]):
        self.best, self.place, self.parts = (name_score(name), name), place, parts


class _Values:
    """All that names are given, in order, and what each name holds now."""

    def __init__(self) -> None:
        self.all: list[_Given] = []
        self.held: dict[str, _Given] = {}

    def give(self, name: str, place: tuple[int, int] | None, more: bool = False, of: str | None = None) -> None:
        """A literal, or what the name ``of`` holds; ``more``: on top of what ``name`` holds."""
        parts = [self.held[n] for n in ([name] if more and name in self.held else []) + ([of] if of else [])]
        self.held[name] = _Given(name, place, parts)
        self.all.append(self.held[name])

    def see(self, name: str, place: tuple[int, int]) -> None:
        """A literal that no name holds."""
        self.all.append(_Given(name, place, []))

    def places(self) -> dict[tuple[int, int], tuple[float, str]]:
        """The literals with their best names; scores go from names to what they were given."""
        found: dict[tuple[int, int], tuple[float, str]] = {}
        for given in reversed(self.all):
            for part in given.parts:
                if given.best[0] > part.best[0]:
                    part.best = given.best
        for given in self.all:
            if given.place and given.best[0] > found.get(given.place, (0.0, ""))[0]:
                found[given.place] = given.best
        return found


def named_literals(text: str) -> Iterator[tuple[str, int, int, float]]:
    """(best name, begin, end, score) of the literals given to names that say something."""
    values = _Values()
    begin, state = 0, _State()
    for raw in text.split("\n"):
        line = raw.rstrip("\r")
        if state.stage != "name" or "=" in line or ":" in line or "</" in line:
            _read_line(text, line, begin, values, state)
        begin += len(raw) + 1
    by_end: dict[int, list[int]] = {}
    found = values.places()
    for a, b in found:
        by_end.setdefault(b, []).append(a)
    for b, begins in by_end.items():
        begins.sort()
        # Of several values with one end the longest has no blanks, being unquoted, or all are looked at.
        plain = len(begins) > 1 and not SPACE.search(text, begins[0], b)
        scores = _scores_of_tails(text, begins, b) if plain else {a: literal_score(text[a:b]) for a in begins}
        for a in begins:
            weight, name = found[a, b]
            yield name, a, b, weight * scores[a]


class _State:
    """What the lexer carries over a line end: a target that waits for its literal or for more of it."""

    def __init__(self) -> None:
        self.target, self.adding, self.stage, self.set, self.indent = "", False, "name", "", 0


def _indent(line: str) -> int:
    return len(line) - len(line.lstrip(" \t"))


def _literal(value: str, begin: int) -> tuple[int, int]:
    """The place of a literal, without a scheme in front."""
    schemed = SCHEMED.match(value)
    return (begin + schemed.start(1), begin + schemed.end(1)) if schemed else (begin, begin + len(value))


def _block(text: str, at: int, indent: int) -> tuple[int, int] | None:
    """The lines from ``at`` that are indented by more than ``indent``, if each is one word."""
    first, end = -1, -1
    while at < len(text):
        stop = text.find("\n", at)
        stop = stop if stop >= 0 else len(text)
        line = text[at:stop].rstrip()
        if line:
            if _indent(line) <= indent:
                break
            if len(line.split()) > 1:
                return None
            first, end = at + _indent(line) if first < 0 else first, at + len(line)
        at = stop + 1
    return (first, end) if first >= 0 else None


@lru_cache(maxsize=8)
def _token(unclosed: frozenset[str]) -> re.Pattern:
    """Tokens of a line in which some quotes have no partner."""
    closed = "|".join(pattern for quote, pattern in STRINGS.items() if quote not in unclosed)
    return re.compile(f"(?P<string>{closed})|{REST}" if closed else f"(?P<string>(?!))|{REST}")


class _Bare:
    """Unquoted values of a line: up to a stop, with nothing but blanks, a comment or a comma behind.

    Stops are looked for once in a line, so that a value inside of a value costs nothing more.
    """

    def __init__(self, line: str):
        self.line, self.stops, self.ends = line, None, {}

    def after(self, at: int) -> tuple[int, int] | None:
        begin = BLANKS.match(self.line, at).end()
        scheme = SCHEME_FIRST.match(self.line, begin)
        return (self._value(scheme.end()) if scheme else None) or self._value(begin)

    def _value(self, begin: int) -> tuple[int, int] | None:
        if self.stops is None:
            self.stops = [m.start() for m in STOP.finditer(self.line)] + [len(self.line)]
        stop = self.stops[bisect_left(self.stops, begin)]
        if stop not in self.ends:
            behind = BLANKS.match(self.line, stop).end()
            whole = behind == len(self.line) or self.line[behind] in ",;#"
            self.ends[stop] = stop if whole else self.line.rfind("#", 0, stop)
        end = self.ends[stop]
        return (begin, end) if end > begin else None


def _read_line(text: str, line: str, offset: int, values: _Values, state: _State) -> None:
    """Note what names are given in one line of ``text``, which begins at ``offset``."""
    carried = state.stage == "value"  # nothing but blanks so far on the line after a separator
    target, adding, stage = state.target, state.adding, state.stage
    if not line.strip():
        return
    alone = ALONE.match(line) if carried and state.set == ":" and _indent(line) > state.indent else None
    if alone:
        values.give(target, (offset + alone.start(1), offset + alone.end(1)), more=True)
        target, stage, carried = "", "name", False
    at, bare, unclosed = 0, _Bare(line), frozenset()
    while token := _token(unclosed).search(line, at):
        at = token.end()
        kind = token.lastgroup if token.lastgroup not in ("tagname", "tagtext") else "tag"
        if kind == "other" and token[0] in STRINGS:
            unclosed |= {token[0]}  # what follows is read alike from here and from there, so others don't close either
        header = HEADER.match(token[0][1:-1]) if kind == "string" and ":" in token[0] else None
        if header:
            inside = offset + token.start() + 1
            values.see(header[1], (inside + header.start(2), inside + header.end(2)))
        wrapped = WRAPPED.match(text, offset + token.start()) if stage == "value" and token[0][0] in "\"'`" else None
        if wrapped and kind == "string" and len(wrapped["q"]) == 1:
            wrapped = None  # a string that ends on its line
        if token["tag"]:
            values.see(token["tagname"], (offset + token.start("tagtext"), offset + token.end("tagtext")))
            target, stage = "", "name"
        elif kind == "set" and target and not carried and token[0] in ("=", ":", ":=", "=>"):
            stage, adding, state.set, state.indent = "value", False, token[0], _indent(line)
            place = bare.after(at) if token[0] != "=>" else None
            place = (offset + place[0], offset + place[1]) if place else None
            if place and line[place[0] - offset : min(place[1] - offset, place[0] - offset + LONGEST_NAME + 1)] in values.held:
                place = None
            if token[0] == ":" and BLOCK_MARK.match(line, at):
                place = _block(text, offset + len(line) + 1 + text.startswith("\r", offset + len(line)), state.indent)
            if place:
                values.give(target, place, more=True)
        elif wrapped:
            values.give(target, (wrapped.start("key"), wrapped.end("key")), adding)
            stage, at = "more", wrapped.end() - offset
            if at > len(line):
                target, stage = "", "name"
                break
        elif stage == "value" and kind == "string" and not (carried and SEPARATES.match(line, at)):
            values.give(target, _literal(token[0][1:-1], offset + token.start() + 1), adding)
            stage = "more"
        elif stage == "value" and kind == "name" and token[0] in values.held and not carried:
            values.give(target, None, adding, token[0])
            stage = "more"
        elif stage == "value" and (token[0] == "(" or token[0] == "\\" and NOTHING_MORE.match(line, at)):
            continue
        elif stage == "more" and kind == "plus":
            stage, adding = "value", True
        elif kind == "name":
            target, stage = token[0], "name"
        elif kind == "string":
            target, stage = token[0][1:-1], "name"
        elif kind != "set" or stage != "name":
            target, stage = "", "name"
        carried = False
    state.target, state.adding, state.stage = target if stage != "name" else "", adding, stage


def spans(text: str) -> list[tuple[int, int, int, str, float]]:
    """(begin, kind number, end, name, score) of all spans of one text, in order."""
    found = []
    low = text.lower()
    if any(stem in low for stem in STEMS):
        found += [(m.start(), 0, m.end(), "", 1.0) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), "", 1.0) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end(), "", 1.0) for m in HEX.finditer(text)]
    if "-----BEGIN" in text:
        for m in PEM.finditer(text):
            score = name_score(m["label"]) * literal_score(m[0])
            if score >= LEAST_SCORE:
                found.append((m.start(), 3, m.end(), m["label"], score))
    if ("=" in text or ":" in text or "</" in text) and SENSITIVE.search(low):
        named: dict[tuple[int, int], tuple[str, float]] = {}
        for name, begin, end, score in named_literals(text):
            if score >= LEAST_SCORE:
                named[begin, end] = (name, score)
        found += [(begin, 3, end, name, score) for (begin, end), (name, score) in named.items()]
    return sorted(found)


SPANS = "array<struct<kind: string, begin: bigint, end: bigint, name: string, score: double>>"
_SPAN = pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())])


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, spans) of every row."""
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1):
            found = [
                [{"kind": KINDS[k], "begin": a, "end": b, "name": name, "score": score} for a, k, b, name, score in spans(text or "")]
                for text in batch.column(1).to_pylist()
            ]
            yield batch_of(["doc_id", "spans"], [batch.column(0), found], [pa.int64(), pa.list_(_SPAN)])

    return rows.mapInArrow(run, f"doc_id bigint, spans {SPANS}")


def redacted(text: str | None, mark: str = "[SECRET]") -> str | None:
    """``text`` with each run of overlapping spans replaced by ``mark``."""
    if not text:
        return text
    out, at, end = [], 0, -1
    for begin, _, until, _, _ in spans(text):
        if begin >= end:
            out += [text[at:begin], mark]
        end = max(end, until)
        at = end
    return "".join(out) + text[at:]


def redact(text: Column) -> Column:
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(redacted, na_action="ignore")

    return run(text)


def digests(scanned: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as text."""

    def listed(chosen: Column) -> Column:
        return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "named")
    return scanned.select(
        "doc_id", *[number(kind) for kind in KINDS[:3]], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )
