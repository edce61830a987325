"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

The encoding of every prefix of a piece is known as its bytes arrive: the last token of a prefix's encoding is
the longest token that ends there and may follow the last token of the prefix before it, where token b may
follow token a if encoding their joined bytes gives (a, b). A state is what later bytes can still need: the
positions from which a longer token may yet start, and the tokens that lead to each. What the tokens to all of these
positions begin with is settled and emitted at once. A live position lies less than a token's length back, and
encodings of prefixes a few bytes apart soon agree, so that the lookahead stays within a few tokens.
States and transitions are made when first met and kept in a table; texts then mostly cost look-ups.

Decoding a stream of ids moves an automaton of UTF-8 over the tokens' bytes. Between chunks it holds its state and the
bytes of an incomplete character; ids that give no text are an error.

Defined cases: a null text counts as empty and has no ids; repeated rows are encoded alike; an empty table
gives an empty result; very long texts and very long pieces are encoded whole; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from nomograph.llm.common import pick, small_batches, table, worker_table

#: Transitions that a worker keeps for good, those made first and so the commonest, and further ones until these start
#: anew; pieces in each of two generations, of which a full one replaces the older. What is forgotten is made again, so the
#: bounds change no result.
KEPT_MOVES, FRESH_MOVES = 300_000, 100_000
MOST_PIECES = 120_000
#: First bytes of pieces whose state a worker keeps, and of how many.
HEAD, MOST_HEADS = 6, 100_000
#: Pieces longer than this aren't kept.
LONG_PIECE = 64


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank, from a file of lines: base64 of the token, its rank."""
    with open(path, "rb") as f:
        found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    return [found[i] for i in range(len(found))]


Chain = tuple[int, ...]


def _pack(root: int, chains: list[Chain]) -> bytes:
    return b"".join([(root + 1).to_bytes(3), *[len(c).to_bytes(3) + b"".join([t.to_bytes(3) for t in c]) for c in chains]])


def _unpack(state: bytes) -> tuple[int, list[Chain]]:
    chains, at = [], 3
    while at < len(state):
        end = at + 3 + 3 * int.from_bytes(state[at : at + 3])
        chains.append(tuple([int.from_bytes(state[i : i + 3]) for i in range(at + 3, end, 3)]))
        at = end
    return int.from_bytes(state[:3]) - 1, chains


def _coded(ids: Chain) -> bytes:
    return b"".join([i.to_bytes(4, "little") for i in ids])


class Transducer:
    """Encodes single pieces. Ids are ranks; every single byte must be a token."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.prefixes = {t[:k] for t in tokens for k in range(1, len(t))}
        self.follows: dict[int, bool] = {}
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.edges: tuple[dict[int, list[tuple[bytes, int]]], ...] = ({}, {})
        #: A state, packed by _pack: the last settled token if a live position stands right after it (else -1), and for each live position, the present one last, the tokens from there on that lead to it.
        self.states: list[bytes] = [_pack(-1, [()])]
        self.number = {self.states[0]: 0}
        #: What is left to emit if the piece ends in a state, and what transitions emit, each once, as coded ids.
        self.ends: list[bytes] = [b""]
        self.outputs: list[bytes] = [b""]
        self.output = {b"": 0}
        #: (state, byte) -> (next state, output), each packed in one number.
        self.moves: dict[int, int] = {}
        self.fresh: dict[int, int] = {}
        self.kept_states = self.kept_outputs = 1
        self.heads: dict[bytes, tuple[int, bytes]] = {}
        self.now = 0

    def _forget(self) -> None:
        for state in self.states[self.kept_states :]:
            del self.number[state]
        for out in self.outputs[self.kept_outputs :]:
            del self.output[out]
        del self.states[self.kept_states :], self.ends[self.kept_states :], self.outputs[self.kept_outputs :]
        self.fresh.clear()

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the token's last merge joins; None for a byte, and for a token that merging its own bytes doesn't give."""
        if token not in self.parts:
            whole, ranks = self.tokens[token], self.ranks
            parts = [whole[i : i + 1] for i in range(len(whole))]
            while len(parts) > 2:
                best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], sys.maxsize))
                if parts[best] + parts[best + 1] not in ranks:
                    break
                parts[best : best + 2] = [parts[best] + parts[best + 1]]
            self.parts[token] = (ranks[parts[0]], ranks[parts[1]]) if len(parts) == 2 else None
        return self.parts[token]

    def reachable(self, token: int) -> bool:
        return len(self.tokens[token]) == 1 or self.split(token) is not None

    def _edge(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """What stands at the token's left (0) or right (1) edge while its bytes merge, from a byte to the token: (bytes, the rank of the merge that ends its time)."""
        known = self.edges[side].get(token)
        if known is None:
            known, ends = [], sys.maxsize
            at: int | None = token
            while at is not None:
                known.append((self.tokens[at], ends))
                parts = self.split(at) if len(self.tokens[at]) > 1 else None
                ends, at = at, parts[side] if parts else None
            known.reverse()
            self.edges[side][token] = known
        return known

    def may_follow(self, a: int, b: int) -> bool:
        """Whether no merge crosses from a to b: each pair of neighbours at the boundary must end before its own merge would come. Of equal ranks the left merge is first."""
        known = self.follows.get(a << 32 | b)
        if known is None:
            left, right, i, j, known = self._edge(a, 1), self._edge(b, 0), 0, 0, True
            while True:
                (x, x_ends), (y, y_ends) = left[i], right[j]
                across = self.ranks.get(x + y, sys.maxsize)
                if across < x_ends and across <= y_ends and across != sys.maxsize:
                    known = False
                    break
                if x_ends == y_ends == sys.maxsize:
                    break
                if x_ends <= y_ends:
                    i += 1
                else:
                    j += 1
            self.follows[a << 32 | b] = known
        return known

    def _move(self, state: int, byte: int) -> int:
        """Packed: the next state and the output, which is what the tokens to all live positions begin with."""
        root, chains = _unpack(self.states[state])
        tokens, prefixes, new, live = self.tokens, self.prefixes, None, []
        tail = b"".join([tokens[t] for t in chains[-1]]) + bytes([byte])
        for chain in chains:  # the earliest position first: the longest token that may end here
            piece = tail
            for t in chain:
                piece = piece[len(tokens[t]) :]
            if new is None:
                rank = self.ranks.get(piece, -1)
                if rank >= 0 and self.reachable(rank):
                    before = chain[-1] if chain else root
                    if before < 0 or self.may_follow(before, rank):
                        new = (*chain, rank)
            if piece in prefixes:
                live.append(chain)
        if new is None:
            raise ValueError("a byte that is no token")
        n = 0
        if live:
            for same in zip(*live, new, strict=False):
                if len(set(same)) > 1:
                    break
                n += 1
        else:
            n = len(new)
        live.append(new)
        if n:
            root, out, live = new[n - 1], _coded(new[:n]), [c[n:] for c in live]
            done = self.output.get(out)
            if done is None:
                done = self.output[out] = len(self.outputs)
                self.outputs.append(out)
        else:
            done = 0
        key = _pack(-1 if live[0] else root, live)
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
            self.ends.append(_coded(live[-1]))
        return to << 32 | done

    def _new_move(self, key: int, state: int, byte: int) -> int:
        if len(self.moves) < KEPT_MOVES:
            move = self.moves[key] = self._move(state, byte)
            self.kept_states, self.kept_outputs = len(self.states), len(self.outputs)
        else:
            move = self.fresh[key] = self._move(state, byte)
        return move

    def steps(self, piece: bytes) -> Iterator[bytes]:
        """A byte at a time: the coded ids that each byte settles, and at last what the end settles."""
        state = 0
        for k in range(len(piece)):
            yield b"".join(self._run(piece[k : k + 1], state))
            state = self.now
        yield self.ends[state]

    def _run(self, data: bytes, state: int) -> list[bytes]:
        """The coded ids that each byte settles; now is the state after it."""
        moves, outputs, out = self.moves, self.outputs, []
        for byte in data:
            key = state << 8 | byte
            move = moves.get(key)
            if move is None:
                move = self.fresh.get(key)
                if move is None:
                    move = self._new_move(key, state, byte)
            state = move >> 32
            if done := move & 0xFFFFFFFF:
                out.append(outputs[done])
        self.now = state
        return out

    def encode(self, piece: bytes) -> bytes:
        """The piece's ids as little-endian unsigned 32-bit integers. Where the first bytes of pieces lead is remembered."""
        if len(self.fresh) > FRESH_MOVES:
            self._forget()
        if len(self.follows) > FRESH_MOVES:
            self.follows.clear()
        head = piece[:HEAD]
        known = self.heads.get(head)
        if known is None:
            out = b"".join(self._run(head, 0))
            known = (self.now, out)
            if self.now < self.kept_states and len(self.heads) < MOST_HEADS:
                self.heads[head] = known
        state, out = known
        rest = self._run(piece[HEAD:], state)
        return b"".join([out, *rest, self.ends[self.now]])


class Encoder(dict):
    """Piece -> its ids as little-endian unsigned 32-bit integers; a bounded memory of short pieces."""

    def __init__(self, tokens: list[bytes], pattern: str):
        super().__init__()
        self.transducer, self.pieces = Transducer(tokens), regex.compile(pattern).findall
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        coded = self.older.get(piece)
        if coded is None:
            coded = self.transducer.encode(piece.encode())
        if len(piece) <= LONG_PIECE:
            if len(self) >= MOST_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = coded
        return coded

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pieces(text)))


#: UTF-8 automaton: lead byte -> bytes still to come. Bytes 0x80-0xBF continue a character.
def _utf8_moves() -> tuple[list[dict[int, int]], list[int]]:
    """The automaton of UTF-8: for each state what a byte leads to, and the bytes of an incomplete character that it holds. State 0 lies between characters; a byte without a move is an error."""
    states: dict[tuple[int, int, int, int], int] = {(0, 0, 0, 0): 0}  # bytes held, bytes to come, the next byte's least and greatest value
    moves: list[dict[int, int]] = [{b: 0 for b in range(0x80)}]

    def state(held: int, left: int, low: int = 0x80, high: int = 0xBF) -> int:
        if not left:
            return 0
        key = (held, left, low, high)
        if key not in states:
            states[key] = len(moves)
            moves.append({})
            moves[states[key]].update({b: state(held + 1, left - 1) for b in range(low, high + 1)})
        return states[key]

    for lead in range(0xC2, 0xF5):
        low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(lead, (0x80, 0xBF))
        moves[0][lead] = state(1, 1 + (lead >= 0xE0) + (lead >= 0xF0), low, high)
    return moves, [held for held, *_ in states]


class Vocabulary:
    """Tokens with the automaton's moves over them: most tokens are whole characters and leave it between characters; the others are read byte by byte."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.moves, self.held = _utf8_moves()
        self.whole = np.array([self.move(0, t) == 0 for t in tokens], bool)

    def move(self, state: int, data: bytes) -> int:
        """The state after data; -1 for an error."""
        for byte in data:
            state = self.moves[state].get(byte, -1)
            if state < 0:
                break
        return state


class StreamDecoder:
    """Ids in chunks -> text in chunks. Between chunks only the automaton's state and the bytes of an incomplete character are held."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.state, self.held = vocabulary, 0, b""

    def feed_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes of the characters that these ids complete."""
        v, state, at = self.vocabulary, self.state, -1
        for k in [*np.flatnonzero(~v.whole[ids]).tolist(), len(ids)]:
            if state and k != at + 1 or state < 0:
                raise ValueError("the ids are no text")
            if k < len(ids):
                state, at = v.move(state, v.tokens[ids[k]]), k
        data = self.held + b"".join(map(v.tokens.__getitem__, ids.tolist()))
        end = len(data) - v.held[state]
        self.state, self.held = state, data[end:]
        return data[:end]

    def feed(self, ids: Iterable[int]) -> str:
        return self.feed_bytes(np.array(list(ids), np.int64)).decode("utf-8")

    def end(self) -> None:
        if self.state:
            raise ValueError("the stream ends inside a character")


#: Ids decoded at a time.
CHUNK_IDS = 1 << 14


def decode_stream(ids: np.ndarray, vocabulary: Vocabulary) -> Iterator[bytes]:
    decoder = StreamDecoder(vocabulary)
    for i in range(0, len(ids), CHUNK_IDS):
        yield decoder.feed_bytes(ids[i : i + CHUNK_IDS])
    decoder.end()


def _encoder(shared) -> tuple[Encoder, Vocabulary]:
    """One encoder for each worker process and vocabulary; its tables outlive tasks."""
    tokens, pattern, name = shared.value
    return worker_table(f"bpe {name}", lambda: (Encoder(tokens, pattern), Vocabulary(tokens)))


def _shared(spark: SparkSession, ranks: str | None, pattern: str | None):
    """The vocabulary, read by the driver and broadcast: its size is the rank file's, whatever the corpus."""
    if ranks is None or pattern is None:
        import public_tokenizers

        ranks, pattern = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    tokens = read_ranks(ranks)
    return spark.sparkContext.broadcast((tokens, pattern, hashlib.sha256(b"\0".join([pattern.encode(), *tokens])).hexdigest()))


def _decoded_sha256(coded: bytes, vocabulary: Vocabulary) -> str:
    """The digest of the text that the ids give back, decoded as a stream."""
    digest = hashlib.sha256()
    for part in decode_stream(np.frombuffer(coded, "<u4"), vocabulary):
        digest.update(part)
    return digest.hexdigest()


def encode(docs: DataFrame, ranks: str | None = None, pattern: str | None = None, decoded: bool = False) -> DataFrame:
    """doc_id and ids (array of int) of every row of docs, and on demand the digest of the text decoded from them. Narrow: no shuffle."""
    small_batches(docs.sparkSession)
    shared = _shared(docs.sparkSession, ranks, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, vocabulary = _encoder(shared)
        for batch in batches:
            coded = [encoder.encode(x or "") for x in batch.column(1).to_pylist()]
            offsets = [0]
            for x in coded:
                offsets.append(offsets[-1] + len(x) // 4)
            values = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(coded))])
            columns, names = [batch.column(0).cast(pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)], ["doc_id", "ids"]
            if decoded:
                columns, names = [*columns, pa.array([_decoded_sha256(x, vocabulary) for x in coded], pa.string())], [*names, "decoded_sha256"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>" + ", decoded_sha256 string" * decoded)


def round_trip(docs: DataFrame, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids and of the text decoded from them, of every row."""
    small_batches(docs.sparkSession)
    shared = _shared(docs.sparkSession, ranks, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, vocabulary = _encoder(shared)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for text in batch.column(1).to_pylist():
                coded = encoder.encode(text or "")
                counts.append(len(coded) // 4)
                of_ids.append(hashlib.sha256(coded).hexdigest())
                of_text.append(_decoded_sha256(coded, vocabulary))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
