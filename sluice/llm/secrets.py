"""Secret scans.

An Aho-Corasick automaton over keywords finds the places worth a look, regular
expressions anchored there read the match, and tokens that carry a checksum
must satisfy it. Runs of hex digits have no keyword: a run of n characters
covers n // s probes at every s-th character, so sampled probes take the
keyword's place and lose no run.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from sluice.llm.batches import Kernel, map_slices, texts_of

#: The base kinds in their order, and the least length of what counts.
KINDS = ("assign", "access", "hex")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32
#: Prefixes of tokens that end in a checksum of six base-62 digits over what follows the prefix.
CHECKED = {"forge": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "registry": ("npm_",)}
CHECKED_BODY, CHECK_DIGITS = 30, 6
#: Every kind, in the order in which spans with one start are listed.
ALL_KINDS = (*KINDS, *CHECKED)

_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_STEP = HEX_LENGTH // 2


def checksum(body: str) -> str:
    """CRC-32 of the body as six base-62 digits."""
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(CHECK_DIGITS):
        value, digit = divmod(value, 62)
        out = _DIGITS[digit] + out
    return out


class Scanner:
    def __init__(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
            self.automaton.add_word(word, ("assign", len(word)))
        self.automaton.add_word("akia", ("access", 4))
        for kind, prefixes in CHECKED.items():
            for prefix in prefixes:
                self.automaton.add_word(prefix, (kind, len(prefix)))
        self.automaton.make_automaton()
        self.assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
        self.access = re.compile(ACCESS)
        self.hex = re.compile(HEX)
        self.probes = re.compile("[0-9a-f]{2,}")
        self.checked = re.compile(rf"[A-Za-z0-9]{{{CHECKED_BODY + CHECK_DIGITS}}}(?![A-Za-z0-9_])")

    def hex_runs(self, text: str) -> list[tuple[int, int]]:
        """Maximal runs of at least HEX_LENGTH hex digits: each covers two neighbouring probes."""
        out: list[tuple[int, int]] = []
        for probe in self.probes.finditer(text[::_STEP]):
            for at in range(probe.start() * _STEP, (probe.end() - 1) * _STEP, _STEP):
                if out and at < out[-1][1]:
                    continue
                # a run through this probe and the next one reads on from here
                end = self.hex.match(text, at).end()
                if end <= at + _STEP:
                    continue
                start = at
                while start and text[start - 1] in "0123456789abcdef":
                    start -= 1
                if end - start >= HEX_LENGTH:
                    out.append((start, end))
        return out

    def scan(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, kind) of every span: by start, then by order of the kinds."""
        low = text.lower()
        if len(low) != len(text):  # some letters lower-case to two
            low = "".join(c.lower() if c.isascii() else c for c in text)
        spans = [(start, end, "hex") for start, end in self.hex_runs(text)]
        until = {"assign": 0, "access": 0}
        for end, (kind, length) in self.automaton.iter(low):
            start = end - length + 1
            if kind in CHECKED:
                body = self.checked.match(text, end + 1)
                if body and low[start : end + 1] == text[start : end + 1]:
                    word = body.group()
                    if checksum(word[:CHECKED_BODY]) == word[CHECKED_BODY:]:
                        spans.append((start, body.end(), kind))
            elif start >= until[kind]:
                found = (self.assign if kind == "assign" else self.access).match(text, start)
                if found:
                    until[kind] = found.end()
                    if kind == "assign" and len(found[2]) >= ASSIGN_VALUE or kind == "access" and len(found[0]) >= ACCESS_LENGTH:
                        spans.append((start, found.end(), kind))
        spans.sort(key=lambda s: (s[0], ALL_KINDS.index(s[2]), s[1]))
        return spans


def _find(df: DataFrame, id_column: str, text_column: str, extra: str, fill) -> DataFrame:
    def make() -> Kernel:
        scanner = Scanner()

        def kernel(batch: pa.RecordBatch) -> dict:
            texts = texts_of(batch, text_column)
            return fill(batch, texts, [scanner.scan(t) for t in texts])

        return kernel

    kind = dict(df.dtypes)[id_column]
    return map_slices(df.select(id_column, text_column), make, f"{id_column} {kind}, {extra}")


def find_secrets(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end>>) of every whole text, in code points, end exclusive.

    Null and empty texts have no spans; repeated rows give repeated rows; an
    empty table gives an empty result; other columns are not read.
    """

    def fill(batch: pa.RecordBatch, texts: list[str], found: list) -> dict:
        return {
            id_column: batch.column(id_column),
            "spans": [[{"kind": k, "start": a, "end": b} for a, b, k in spans] for spans in found],
        }

    return _find(df, id_column, text_column, "spans array<struct<kind:string,start:bigint,end:bigint>>", fill)


def digest_of_secrets(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts by base kind, a digest of the base spans, and all spans as text."""

    def joined(spans: list[tuple[int, int, str]]) -> str:
        return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)

    def fill(batch: pa.RecordBatch, texts: list[str], found: list) -> dict:
        base = [[s for s in spans if s[2] in KINDS] for spans in found]
        out = {id_column: batch.column(id_column)}
        for kind in KINDS:
            out[f"n_{kind}"] = [sum(s[2] == kind for s in spans) for spans in base]
        out["base_sha256"] = [hashlib.sha256(joined(spans).encode()).hexdigest() for spans in base]
        out["spans"] = [joined(spans) for spans in found]
        return out

    ddl = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return _find(df, id_column, text_column, ddl, fill)


def mask_secrets(df: DataFrame, text_column: str = "text", mask: str = "[{kind}]", length_column: str | None = "n_chars") -> DataFrame:
    """Every span of every text replaced by its kind's mask; the other columns and all rows stay.

    Overlapping spans are replaced together by the mask of the first. A length
    column, if there is one, counts the code points that are left. Null texts
    stay null.
    """
    names = df.columns
    counted = length_column if length_column in names else None

    def make() -> Kernel:
        scanner = Scanner()

        def masked(text: str) -> str:
            out, at = [], 0
            for start, end, kind in scanner.scan(text):
                if start >= at:
                    out += text[at:start], mask.format(kind=kind)
                at = max(at, end)
            return "".join(out) + text[at:]

        def kernel(batch: pa.RecordBatch) -> dict:
            old = batch.column(text_column).to_pylist()
            new = [t and masked(t) for t in old]
            out = {n: batch.column(n) for n in names if n not in (text_column, counted)} | {text_column: new}
            if counted:
                before = batch.column(counted).to_pylist()
                out[counted] = [b if a == t or t is None else len(t) for a, t, b in zip(old, new, before)]
            return out

        return kernel

    ddl = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
    return map_slices(df, make, ddl)
