"""Byte-level BPE as a finite-state transducer, and streaming decoding.

Token sequences that BPE can produce are exactly those whose neighbours are compatible: no
merge crosses the border between two tokens before both are whole. This compiles the
merges into a nondeterministic transducer that reads bytes, guesses where tokens end and
writes tokens. It is determinised while it runs: a state is the set of open guesses, each
with the tokens it has written and the others have not; what all guesses agree on is
emitted. A guess dies as soon as its bytes begin no token, so output lags behind input by
less than the longest token. States and moves are remembered and rebuilt on demand.

Decoding joins token bytes by a UTF-8 state machine whose state, the bytes of an unfinished
character, is carried from token to token.
"""

from __future__ import annotations

import base64
import functools
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import is_latin, latin_pattern, slices, table

#: States, pairs of tokens, decoder moves and pieces kept per Python worker; what a full
#: memory lacks is found anew, which costs time and changes nothing.
REMEMBERED, PIECES = 1 << 16, 1 << 17
#: Inputs that meet a state without the move they need before moves are compiled.
VISITS = 2
_WHOLE = 1 << 20
_NONE = np.zeros(0, np.int32)


class Merges:
    """Tokens with their ranks, the trie of those that merges make, and which two may stand
    side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.halves: dict[bytes, tuple[bytes, bytes]] = {}
        self._sides: dict[tuple[bytes, int], list[tuple[bytes, float, float]]] = {}
        self._fits: dict[int, bool] = {}
        #: Nodes by parent and byte, the token of a node (-1: none), whether it has children.
        self.trie: dict[int, int] = {}
        self.token_at, self.open_at = [-1], [True]
        for token, rank in ranks.items():
            parts = self.merged(token, rank) if len(token) > 1 else []
            if len(parts) == 2:
                self.halves[token] = (parts[0], parts[1])
            elif len(token) > 1:
                continue  # no merges make it, so it is only ever a whole piece
            node = 0
            for byte in token:
                self.open_at[node] = True
                edge = node << 8 | byte
                node = self.trie.get(edge, -1)
                if node < 0:
                    node = self.trie[edge] = len(self.token_at)
                    self.token_at.append(-1)
                    self.open_at.append(False)
            self.token_at[node] = rank

    @functools.cached_property
    def whole(self) -> dict[int, str]:
        decoded = {i: token.decode("utf-8", "ignore") for i, token in self.tokens.items()}
        return {i: text for i, text in decoded.items() if text.encode() == self.tokens[i]}

    def merged(self, data: bytes, below: float = float("inf")) -> list[bytes]:
        """``data`` after all merges of a rank under ``below``, lowest rank and leftmost first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, below) for a, b in zip(parts, parts[1:])]
            rank = min(ranks)
            if rank >= below:
                break
            at = ranks.index(rank)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _side(self, token: bytes, side: int) -> list[tuple[bytes, float, float]]:
        """Outermost parts of a token on one side, each with the ranks that make and take it."""
        key = (token, side)
        if key not in self._sides:
            out, taken = [], float("inf")
            while True:
                halves = self.halves.get(token)
                made = self.ranks[token] if halves else -1
                out.append((token, made, taken))
                if not halves:
                    break
                token, taken = halves[side], made
            self._sides[key] = out
        return self._sides[key]

    def fits(self, left: int, right: int) -> bool:
        """Whether BPE leaves the two tokens apart."""
        key = left << 32 | right
        found = self._fits.get(key)
        if found is None:
            if len(self._fits) >= 4 * REMEMBERED:
                self._fits.clear()
            found = self._fits[key] = not self._cross(self.tokens[left], self.tokens[right])
        return found

    def _cross(self, left: bytes, right: bytes) -> bool:
        ranks, starts = self.ranks, self._side(right, 0)
        for x, x_made, x_taken in self._side(left, 1):
            for y, y_made, y_taken in starts:
                rank = ranks.get(x + y)
                # Of equal ranks the leftmost merges first: that inside ``left`` before the
                # crossing one, the crossing one before that inside ``right``.
                if rank is not None and rank < x_taken and rank <= y_taken and x_made < y_taken and y_made < x_taken:
                    return True
        return False


#: A guess: last token (-1: none), trie node of the open bytes, tokens not yet emitted.
Guess = tuple[int, int, tuple[int, ...]]


class _State:
    __slots__ = ("guesses", "moves", "rest", "seen")

    def __init__(self, guesses: tuple[Guess, ...]):
        self.guesses = guesses
        self.moves: dict[int, tuple[tuple[int, ...], _State]] = {}
        self.rest = guesses[-1][2]
        self.seen = 0


def _agreed(guesses: list[Guess]) -> int:
    """How many tokens all guesses have written alike."""
    least, most = min(g[2] for g in guesses), max(g[2] for g in guesses)
    size = 0
    while size < len(least) and least[size] == most[size]:
        size += 1
    return size


class Transducer:
    """Deterministic transducer from bytes to token ids, built as inputs ask for it.

    Moves of a state are compiled once ``VISITS`` inputs lacked one, while there is room;
    other input runs through the guesses themselves.
    """

    def __init__(self, merges: Merges):
        self.merges = merges
        self.start = _State(((-1, 0, ()),))
        self.states: dict[tuple[Guess, ...], _State] = {}

    def _read(self, guesses: Iterable[Guess], data: bytes) -> list[Guess]:
        """The guesses after more bytes: those with open bytes, oldest first, and the one that
        has none. There is always one such, as BPE splits every text in one way."""
        m = self.merges
        child, token_at, open_at, fits, known = m.trie.get, m.token_at, m.open_at, m.fits, m._fits.get
        for byte in data:
            out, whole = [], None
            for last, node, held in guesses:
                node = child(node << 8 | byte)
                if node is None:
                    continue
                if whole is None:
                    token = token_at[node]
                    if token >= 0:
                        fit = last < 0 or known(last << 32 | token)
                        if fit or (fit is None and fits(last, token)):
                            whole = (token, 0, held + (token,))
                if open_at[node]:
                    out.append((last, node, held))
            out.append(whole)
            guesses = out
        return guesses

    def _move(self, state: _State, byte: int) -> tuple[tuple[int, ...], _State]:
        guesses = self._read(state.guesses, bytes((byte,)))
        size = _agreed(guesses)
        emitted = guesses[0][2][:size]
        key = tuple([(last, node, held[size:]) for last, node, held in guesses] if size else guesses)
        after = self.states.get(key)
        if after is None:
            after = self.states[key] = _State(key)
        state.moves[byte] = move = (emitted, after)
        return move

    def write(self, data: bytes) -> tuple[int, ...]:
        """Token ids of one piece."""
        out, state = (), self.start
        for at, byte in enumerate(data):
            move = state.moves.get(byte)
            if move is None:
                state.seen += 1
                if state.seen < VISITS or len(self.states) >= REMEMBERED:
                    return out + self._guessed(state.guesses, data[at:])
                move = self._move(state, byte)
            emitted, state = move
            if emitted:
                out += emitted
        return out + state.rest

    def _guessed(self, guesses: Iterable[Guess], data: bytes) -> tuple[int, ...]:
        out: list[int] = []
        while len(data) > 64:
            guesses = self._read(guesses, data[:64])
            size = _agreed(guesses)
            out += guesses[0][2][:size]
            guesses, data = [(last, node, held[size:]) for last, node, held in guesses], data[64:]
        return (*out, *self._read(guesses, data)[-1][2])


class _Pieces(dict):
    """Token ids of remembered pieces, as 32-bit numbers; a piece that is a token is that
    token, merged or not.

    When the memory is full its pieces become old ones, and those still old are forgotten.
    """

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges, self.transducer = merges, Transducer(merges)
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        out = self.old.get(piece)
        if out is None:
            data = piece.encode("utf-8", "replace")
            whole = self.merges.ranks.get(data)
            out = array("i", self.transducer.write(data) if whole is None else (whole,)).tobytes()
        if len(piece) <= 32:
            if len(self) >= PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = out
        return out


@functools.cache
def _newer() -> frozenset[str]:
    """Characters that are letters or digits here and not in the library that defines the result.

    The two packages follow different Unicode versions; each character either calls a
    letter or digit is asked once.
    """
    out = []
    for kind in (r"\p{L}", r"\p{N}"):
        theirs = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        ours = regex.compile(kind)
        chars = (chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000)
        out += [c for c in chars if ours.match(c) and not theirs.encode_ordinary(c)]
    return frozenset(out)


class _Cut:
    """Pieces of a text by ``pattern``."""

    def __init__(self, pattern: str):
        self.usual, self.latin, self.newer = regex.compile(pattern), latin_pattern(pattern), _newer()
        gone = f"[{''.join(sorted(self.newer))}]" if self.newer else ""
        strict = pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:(?:NEW)|[^\s\p{L}\p{N}])").replace(r"\p{L}+", r"(?:(?!NEW)\p{L})+").replace(r"\p{N}+", r"(?:(?!NEW)\p{N})+")
        self.strict = regex.compile(strict.replace("NEW", gone)) if gone else self.usual

    def __call__(self, text: str) -> Iterable[str]:
        if self.latin and is_latin(text):
            pattern = self.latin
        else:
            pattern = self.usual if self.newer.isdisjoint(text) else self.strict
        if len(text) <= _WHOLE:
            return pattern.findall(text)
        return (m[0] for m in pattern.finditer(text))


class Decoder:
    """Streaming decoder: ``feed`` token ids, read text; unfinished characters wait.

    Bytes that are no UTF-8 become U+FFFD, one for each longest broken start of a character.
    An id outside the vocabulary counts as such a byte.
    """

    def __init__(self, merges: Merges):
        self.tokens = merges.tokens
        self.moves: dict[tuple[bytes, int], tuple[str, bytes]] = {}
        #: Text of the tokens that leave the machine as they find it, between two characters.
        self.whole = merges.whole

    @staticmethod
    def _byte(held: bytes, byte: int) -> tuple[str, bytes]:
        if not held:
            if byte < 0x80:
                return chr(byte), b""
            return ("", bytes([byte])) if 0xC2 <= byte <= 0xF4 else ("�", b"")
        lead = held[0]
        low, high = 0x80, 0xBF
        if len(held) == 1:
            low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, low)
            high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, high)
        if not low <= byte <= high:
            out, after = Decoder._byte(b"", byte)
            return "�" + out, after
        held += bytes([byte])
        size = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return ("", held) if len(held) < size else (held.decode(), b"")

    def _token(self, i: int, held: bytes = b"") -> tuple[str, bytes]:
        text = ""
        for byte in self.tokens.get(i, b"\xff"):
            more, held = self._byte(held, byte)
            text += more
        return text, held

    def feed(self, ids: Iterable[int], held: bytes = b"") -> tuple[str, bytes]:
        """Text finished by ``ids``, and the bytes that wait for more."""
        out = []
        for i in ids:
            move = self.moves.get((held, i))
            if move is None:
                if len(self.moves) >= REMEMBERED:
                    self.moves.clear()
                move = self.moves[held, i] = self._token(i, held)
            out.append(move[0])
            held = move[1]
        return "".join(out), held

    def text(self, ids: Iterable[int]) -> str:
        ids = list(ids)
        try:
            return "".join(map(self.whole.__getitem__, ids))
        except KeyError:
            out, held = self.feed(ids)
        return out + "�" if held else out


@functools.cache
def _merges(vocabulary: str) -> Merges:
    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        return Merges({base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)})


@functools.cache
def _coder(vocabulary: str, pattern: str) -> tuple[_Cut, _Pieces]:
    return _Cut(pattern), _Pieces(_merges(vocabulary))


@functools.cache
def _decoder(vocabulary: str) -> Decoder:
    return Decoder(_merges(vocabulary))


def encode_text(text: str, vocabulary: str, pattern: str = public_tokenizers.PATTERN) -> np.ndarray:
    cut, pieces = _coder(vocabulary, pattern)
    return np.frombuffer(b"".join(map(pieces.__getitem__, cut(text))), np.int32)


def decode_ids(ids: Iterable[int], vocabulary: str) -> str:
    return _decoder(vocabulary).text(ids)


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([_NONE, *ids])))


def encode(text: Column, vocabulary: str, pattern: str = public_tokenizers.PATTERN) -> Column:
    """Token ids of a text column, an array of int per row; null and empty texts have none.

    ``vocabulary`` names a public tokenizer's rank file. Each match of ``pattern`` is
    encoded by itself; text outside every match has no tokens.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in (part for batch in batches for part in slices(batch)):
            yield _lists([encode_text(text.as_py() or "", vocabulary, pattern) for text in part])

    return F.arrow_udf(run, "array<int>")(text)


def decode(ids: Column, vocabulary: str) -> Column:
    """Text of an array of token ids; null for a null array, and null ids are left out."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = (row.values.drop_null().to_pylist() if row.is_valid else None for row in batch)
            yield pa.array([None if row is None else decode_ids(row, vocabulary) for row in rows], pa.string())

    return F.arrow_udf(run, "string")(ids)


def round_trip(text: Column, vocabulary: str, pattern: str = public_tokenizers.PATTERN) -> Column:
    """Struct of ``ids``, as of ``encode``, and ``decoded``, their text, in one Python worker."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in (part for batch in batches for part in slices(batch)):
            ids = [encode_text(text.as_py() or "", vocabulary, pattern) for text in part]
            decoded = pa.array([decode_ids(row.tolist(), vocabulary) for row in ids], pa.string())
            yield pa.StructArray.from_arrays([_lists(ids), decoded], ["ids", "decoded"])

    return F.arrow_udf(run, "ids array<int>, decoded string")(text)


def op13_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Null and empty texts: no tokens and the digest of nothing. Repeated rows stay rows of
    their own, an empty table gives no rows, other columns are ignored."""
    name = "byte_bpe_multi_50k.tiktoken"
    coded = table(spark, folder, "documents").select("doc_id", round_trip(F.col("text"), name).alias("r")).select("doc_id", "r.ids", "r.decoded")
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
