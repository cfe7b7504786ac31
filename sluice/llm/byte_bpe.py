"""Byte-level BPE encoding and decoding.

The merges are compiled into a finite-state transducer that is determinised as
texts demand it. A state is the last emitted token and the bytes read since
then, with the last token of the encoding of every prefix of those bytes; the
next byte extends these by one prefix. Tokens that lie on every path the future
can still take are emitted, so the delay is bounded by the longest token.

Why that is exact: under merges of a proper vocabulary the encoding of a prefix
ends in the only token that forms, with the token before it, a pair that the
merges leave alone. A pair is tested on the parts of its tokens that touch.

Decoding is a table walk, and an incremental UTF-8 state machine turns its
bytes into text chunk by chunk, holding back at most three bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from sluice.llm.batches import Kernel, code_points, joined_ids, lists_of, map_slices, packed_lists, texts_of

#: Arcs and pieces a task keeps before it starts afresh; bounds memory, not results.
MAX_ARCS = 500_000
MAX_PIECES = 250_000
#: Bytes of a pre-token between looks at the number of arcs; ids are joined once for each stretch.
STRETCH = 4_096
#: Texts encoded at once.
SLICE = 1_024
#: Later than every merge.
NO_RANK = 1 << 40
#: Ids decoded at once.
DECODE_IDS = 8192
_BYTES = [bytes((b,)) for b in range(256)]


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """The ranks of a .tiktoken file: one base64 token and its rank per line."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class State(dict):
    """From the next byte to (next state, emitted ids); arcs are made on first use, and so is what is emitted under ENDING at the end."""

    __slots__ = ("before", "machine", "pending", "places", "starts", "tokens")
    ENDING = -1

    def __init__(self, machine: BpeTransducer, before: int, pending: bytes, starts: tuple, tokens: tuple, places: tuple):
        #: The last emitted token, the bytes since, start and token of the last token of each prefix of those, places where a longer token is open, with its node.
        self.machine, self.before, self.pending, self.starts, self.tokens, self.places = machine, before, pending, starts, tokens, places

    def __missing__(self, byte: int):
        return self.machine.ending(self) if byte == self.ENDING else self.machine.arc(self, byte)


class BpeTransducer:
    """Bytes of one pre-token in, ids (little-endian unsigned 32-bit) out."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.packed = {i: struct.pack("<I", i) for i in self.token}
        #: A trie of all tokens: (node << 8 | byte) to the next node; of each node its token or -1, and whether a longer token goes on from it.
        self.trie: dict[int, int] = {}
        self.node_token, self.node_open = [-1], [True]
        for token, i in ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                self.node_open[node] = True
                node = self.trie.get(key)
                if node is None:
                    node = self.trie[key] = len(self.node_token)
                    self.node_token.append(-1)
                    self.node_open.append(False)
            self.node_token[node] = i
        self.lefts: dict[int, list[tuple[int, int]]] = {}
        self.rights: dict[int, dict[int, int]] = {}
        self.split: dict[bytes, tuple[bytes, bytes]] = {}
        self.reset()

    def reset(self) -> None:
        self.root = State(self, -1, b"", (), (), ())
        self.states: dict[tuple[int, bytes], State] = {(-1, b""): self.root}
        self.arcs = 0
        self.allowed: dict[int, bool] = {}

    def spine(self, token: int, side: int) -> Iterator[tuple[bytes, int]]:
        """The parts of a token that touch its end (side 1) or start (side 0), the whole first, each with the
        rank of the merge that consumes it: found by undoing the merges that formed it."""
        part, until = self.token[token], NO_RANK
        while True:
            yield part, until
            if len(part) == 1:
                return
            until = self.ranks[part]
            part = self.halves(part)[side]

    def left(self, token: int) -> list[tuple[int, int]]:
        """Of the parts at a token's end from which a longer token goes on: node and rank."""
        found = self.lefts.get(token)
        if found is None:
            found = []
            for part, until in self.spine(token, 1):
                node = 0
                for byte in part:
                    node = self.trie[node << 8 | byte]
                if self.node_open[node]:
                    found.append((node, until))
            self.lefts[token] = found
        return found

    def right(self, token: int) -> dict[int, int]:
        """Of the parts at a token's start: length to rank."""
        found = self.rights.get(token)
        if found is None:
            found = self.rights[token] = {len(part): until for part, until in self.spine(token, 0)}
        return found

    def halves(self, part: bytes) -> tuple[bytes, bytes]:
        """The two parts of a token's last merge."""
        found = self.split.get(part)
        if found is None:
            parts, own = [part[i : i + 1] for i in range(len(part))], self.ranks[part]
            while len(parts) > 2:
                rank, at = min((self.ranks.get(parts[i] + parts[i + 1], NO_RANK), i) for i in range(len(parts) - 1))
                if rank >= own:
                    raise ValueError("a token is not made by the merges of lower rank")
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            found = self.split[part] = (parts[0], parts[1])
        return found

    def pair(self, a: int, b: int) -> bool:
        """Whether the merges leave the tokens a, b side by side.

        They don't if some part at the end of a and some part at the start of b
        form a token whose rank comes before the merges that consume the two.
        Of equal ranks the left merge comes first.
        """
        trie, right, token = self.trie, None, self.token[b]
        for node, left_until in self.left(a):
            for length, byte in enumerate(token, 1):
                node = trie.get(node << 8 | byte)
                if node is None:
                    break
                rank = self.node_token[node]
                if 0 <= rank < left_until:
                    right = right or self.right(b)
                    if rank <= right.get(length, -1):
                        return False
        return True

    def touches(self, before: int, pending: bytes) -> bool:
        """Whether the merges may yet join the end of a token with what follows it: some part at its end and some bytes from ``pending`` on are or begin a token."""
        trie = self.trie
        for node, _ in self.left(before):
            for byte in pending:
                node = trie.get(node << 8 | byte)
                if node is None:
                    break
                if self.node_token[node] >= 0:
                    return True
            else:
                return True
        return False

    def arc(self, state: State, byte: int) -> tuple[State, bytes]:
        """The arc for a byte, made on first use."""
        before, starts, tokens = state.before, state.starts, state.tokens
        pending = state.pending + _BYTES[byte]
        n = len(pending)
        trie, node_token, node_open, allowed, still, last = self.trie, self.node_token, self.node_open, self.allowed, [], -1
        for start, node in (*state.places, (n - 1, 0)):
            node = trie.get(node << 8 | byte)
            if node is None:
                continue
            if node_open[node]:
                still.append((start, node))
            token = node_token[node]
            if token >= 0 and last < 0:
                left = tokens[start - 1] if start else before
                if left >= 0:
                    key = left << 32 | token
                    fine = allowed.get(key)
                    if fine is None:
                        fine = allowed[key] = self.pair(left, token)
                    if not fine:
                        continue
                starts, tokens, last = (*starts, start), (*tokens, token), token
        if last < 0:
            raise ValueError("the vocabulary has no token for a byte")
        # the last boundary on the way to every place from which the future can go on: the end, and where a longer token is open
        cut = n
        for at, _ in still:
            while at != cut:
                if at > cut:
                    at = starts[at - 1]
                else:
                    cut = starts[cut - 1]
        emitted = b""
        if cut:
            out, at = [], cut
            while at:
                out.append(self.packed[tokens[at - 1]])
                at = starts[at - 1]
            emitted = b"".join(reversed(out))
            before, pending, tokens = tokens[cut - 1], pending[cut:], tokens[cut:]
            starts = tuple([s - cut for s in starts[cut:]])
            still = [(s - cut, node) for s, node in still]
        # the last emitted token only matters to a token that is open right after it
        if before >= 0 and still and (still[0][0] or not self.touches(before, pending)):
            before = -1
        found = self.states.get((before, pending))
        if found is None:
            found = self.states[before, pending] = State(self, before, pending, starts, tokens, tuple(still))
        self.arcs += 1
        made = state[byte] = (found, emitted)
        return made

    def ending(self, state: State) -> bytes:
        """What is emitted where the pre-token ends."""
        out, at = [], len(state.pending)
        while at:
            out.append(self.packed[state.tokens[at - 1]])
            at = state.starts[at - 1]
        state[state.ENDING] = found = b"".join(reversed(out))
        return found

    def encode(self, piece: bytes) -> bytes:
        """The packed ids of a pre-token. A pre-token that is itself in the vocabulary is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return self.packed[whole]
        self.room()
        state, done = self.root, []
        for start in range(0, len(piece), STRETCH):
            if start:
                state = self.room(state)
            out = b""
            for byte in piece[start : start + STRETCH]:
                state, emitted = state[byte]
                if emitted:
                    out += emitted
            done.append(out)
        return b"".join([*done, state[State.ENDING]])

    def room(self, state: State | None = None) -> State:
        """Forget all states where they have too many arcs, but for the one that a pre-token is in; a state says all that its arcs are made from."""
        if self.arcs > MAX_ARCS:
            self.reset()
            if state is not None:
                state = self.states[state.before, state.pending] = State(self, state.before, state.pending, state.starts, state.tokens, state.places)
        return self.root if state is None else state


class Encoder:
    """Whole texts to packed ids, by the pattern of byte-level vocabularies, which splits them into pre-tokens.

    Pre-tokens repeat. Where the only white space is spaces and newlines they
    are cut and told apart in Arrow: its expressions can't look ahead, so the
    last of several white-space characters is set off first. Other texts, and
    those of another pattern, are cut one by one.
    """

    #: Fixed value: the pattern that CUTS stands for.
    USUAL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    CUTS = (
        (r"([ \n]+)([ \n])", "\\1\0\\2"),
        (r"\x00([ \n])\z", r"\1"),
        (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\x00 \n\p{L}\p{N}]+|[ \n]+", "\\0\0"),
    )

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pieces = regex.compile(pattern).findall
        self.transducer = BpeTransducer(ranks)
        #: Of every code point whether a text with it is cut by itself: other white space, the mark between pieces, and what
        #: this Python's tables don't know yet and others' may.
        self.other = np.array([chr(c).isspace() or unicodedata.category(chr(c)) == "Cn" for c in range(sys.maxunicode + 1)])
        self.other[[ord(" "), ord("\n")]] = False
        self.other[0] = True
        self.usual = pattern == self.USUAL
        #: Pieces met lately, and those before them.
        self.known: dict[str, bytes] = {}
        self.former: dict[str, bytes] = {}

    def of(self, text: str) -> bytes:
        encode = self.transducer.encode
        return b"".join([encode(p.encode()) for p in self.pieces(text)])

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        if len(self.known) >= MAX_PIECES:
            self.former, self.known = self.known, {}
        known, recall, encode = self.known, self.former.get, self.transducer.encode
        known[""] = b""
        found = list(map(known.get, pieces))
        for i, ids in enumerate(found):
            if ids is None:
                piece = pieces[i]
                found[i] = ids = recall(piece) or encode(piece.encode())
                if len(piece) < 48:
                    known[piece] = ids
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text."""
        odd = {i for i, t in enumerate(texts) if not self.usual or self.other[code_points(t)].any()}
        cut = pa.array(["" if i in odd else t for i, t in enumerate(texts)], pa.large_string())
        for pattern, marked in self.CUTS:
            cut = pc.replace_substring_regex(cut, pattern, marked)
        out = packed_lists(joined_ids(pc.split_pattern(cut, "\0"), lambda distinct: lists_of(self.ids_of(distinct.to_pylist()))))
        for i in odd:
            out[i] = self.of(texts[i])
        return out


class Utf8Machine:
    """Bytes in, text out: holds back a character until its last byte has come.

    A state is what may follow: how many continuation bytes, and the range of
    the first of them. Bytes that cannot follow become U+FFFD, as in the
    standard's practice of replacing each maximal subpart.
    """

    def __init__(self) -> None:
        self.held = b""

    @staticmethod
    def wanted(lead: int) -> tuple[int, int, int]:
        """Continuation bytes after a lead byte, and the range of the first; 0 for no lead of several bytes."""
        if 0xC2 <= lead <= 0xDF:
            return 1, 0x80, 0xBF
        if 0xE0 <= lead <= 0xEF:
            return 2, 0xA0 if lead == 0xE0 else 0x80, 0x9F if lead == 0xED else 0xBF
        if 0xF0 <= lead <= 0xF4:
            return 3, 0x90 if lead == 0xF0 else 0x80, 0x8F if lead == 0xF4 else 0xBF
        return 0, 0, 0

    def open_tail(self, data: bytes) -> int:
        """How many bytes at the end belong to a character that is still open."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 != 0x80:
                need, low, high = self.wanted(byte)
                if back > need or back > 1 and not low <= data[1 - back] <= high:
                    return 0
                return back
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        tail = self.open_tail(data)
        self.held = data[len(data) - tail :]
        return data[: len(data) - tail].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.bytes = np.frombuffer(b"".join(ranks), np.uint8)
        lengths = np.fromiter(map(len, ranks), np.int64, len(ranks))
        ids = np.fromiter(ranks.values(), np.int64, len(ranks))
        self.length = np.zeros(ids.max(initial=-1) + 1, np.int64)
        self.place = np.zeros_like(self.length)
        self.length[ids] = lengths
        self.place[ids] = np.cumsum(lengths) - lengths

    def chunks(self, ids: bytes) -> Iterator[bytes]:
        """The bytes of packed ids, some thousand ids at a time."""
        every = np.frombuffer(ids, "<u4")
        for start in range(0, len(every), DECODE_IDS):
            part = every[start : start + DECODE_IDS]
            lengths = self.length[part]
            ends = np.cumsum(lengths)
            yield self.bytes[np.repeat(self.place[part] - ends + lengths, lengths) + np.arange(ends[-1])].tobytes()

    def stream(self, parts: Iterable[bytes]) -> Iterator[str]:
        """Text from a stream of byte chunks."""
        machine = Utf8Machine()
        for part in parts:
            yield machine.feed(part)
        yield machine.close()


_MADE: dict[int, tuple[Encoder, Decoder]] = {}


def _coders(data: bytes, pattern: str) -> tuple[Encoder, Decoder]:
    """Made once in each Python worker."""
    key = hash((data, pattern))
    if key not in _MADE:
        _MADE.clear()
        ranks = parse_ranks(data)
        _MADE[key] = Encoder(ranks, pattern), Decoder(ranks)
    return _MADE[key]


def encode(df: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids array<long>) of every whole text; null and empty texts have no ids."""
    data = open(ranks_path, "rb").read()

    def make() -> Kernel:
        encoder, _ = _coders(data, pattern)

        def kernel(batch: pa.RecordBatch) -> dict:
            ids = [np.frombuffer(p, "<u4").astype(np.int64) for p in encoder.encode(texts_of(batch, text_column))]
            return {id_column: batch.column(id_column), "ids": ids}

        return kernel

    kind = dict(df.dtypes)[id_column]
    return map_slices(df.select(id_column, text_column), make, f"{id_column} {kind}, ids array<bigint>")


def decode(df: DataFrame, ranks_path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """(id, text) of arrays of ids; a null array is the empty text."""
    data = open(ranks_path, "rb").read()

    def make() -> Kernel:
        _, decoder = _coders(data, "")

        def kernel(batch: pa.RecordBatch) -> dict:
            rows = batch.column(ids_column).to_pylist()
            packed = [np.asarray(r or [], "<u4").tobytes() for r in rows]
            return {id_column: batch.column(id_column), "text": ["".join(decoder.stream(decoder.chunks(p))) for p in packed]}

        return kernel

    kind = dict(df.dtypes)[id_column]
    return map_slices(df.select(id_column, ids_column), make, f"{id_column} {kind}, text string")


def round_trip(df: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode every whole text and decode its ids again, in one pass and without keeping either.

    Returns id, n_tokens, ids_sha256, decoded_sha256 and n_decoded_chars. Null
    texts count as empty; repeated rows give repeated rows; an empty table gives
    an empty result; other columns are not read.
    """
    data = open(ranks_path, "rb").read()

    def make() -> Kernel:
        encoder, decoder = _coders(data, pattern)

        def kernel(batch: pa.RecordBatch) -> dict:
            out: dict = {id_column: batch.column(id_column), "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "n_decoded_chars": []}
            for ids in encoder.encode(texts_of(batch, text_column)):
                digest, chars = hashlib.sha256(), 0
                for said in decoder.stream(decoder.chunks(ids)):
                    digest.update(said.encode())
                    chars += len(said)
                out["n_tokens"].append(len(ids) // 4)
                out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                out["decoded_sha256"].append(digest.hexdigest())
                out["n_decoded_chars"].append(chars)
            return out

        return kernel

    kind = dict(df.dtypes)[id_column]
    ddl = f"{id_column} {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_decoded_chars bigint"
    return map_slices(df.select(id_column, text_column), make, ddl, SLICE)
