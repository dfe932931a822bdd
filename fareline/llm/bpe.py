"""Byte-level BPE as a lazily determinised finite-state transducer.

Two facts make BPE a finite-state map. A sequence of tokens is the encoding of its
bytes exactly when every adjacent pair is the encoding of its own two tokens
(a merge across a boundary would show in that pair alone). And a prefix has at most
one such sequence per length. So the transducer guesses where the current
token began: a hypothesis is (token before, place in the vocabulary's trie). A set of
hypotheses is a state of the determinised machine. Tokens not yet certain are not part of
the state, so texts share states whatever came before: each hypothesis has a register
with its tokens, and a transition says from which hypothesis each new one comes and
which token it appends. When all come from one, its tokens are certain and emitted; what all
registers agree on is emitted too once it has waited as long as the longest token, so lookahead is bounded.
States and transitions are made when first met; they, the decided token pairs and
the encoded matches are tables that are emptied once they have taken their bytes.

Decoding is streaming: an incremental UTF-8 state machine takes tokens as they
come, holds back the bytes of an incomplete character (three at most) and
replaces malformed ones by U+FFFD.

A text is split by the vocabulary's pattern, each match encoded on its own; a
match that is a token itself is that token. Defined results: a null text counts as empty and has no tokens; equal rows
get equal results; an empty table gives an empty table; other columns are not
looked at; a byte without a token in the vocabulary raises ValueError. Texts are encoded whole.
"""

from __future__ import annotations

import base64
import functools
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_batches, held, splitter, whole_text

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
ENTRY_BYTES = 150           # of an entry of the transducer's tables, about
STATE_BYTES = 36 << 20      # of a worker for determinised states and their transitions
STEP_BYTES = 64 << 20       # for hypotheses and their steps
PAIR_BYTES = 16 << 20       # for decided token pairs
PIECE_BYTES = 72 << 20      # for encoded matches
MAX_BELOW = 16              # tokens below a trie node up to which the tokens before are told apart by them alone
LONG_PIECE = 64             # matches of more characters are rarely met again and not held


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file's content."""
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in raw.splitlines() if line.strip())}


class Encoder:
    """The transducer of one rank table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.bytes_of = ranks, {r: t for t, r in ranks.items()}
        self.step, self.token_at, self.inner = {}, [-1], [False]     # trie: node << 8 | byte -> node
        for token, rank in ranks.items():
            node = 0
            for b in token:
                self.inner[node] = True
                at = node << 8 | b
                if at not in self.step:
                    self.step[at] = len(self.token_at)
                    self.token_at.append(-1)
                    self.inner.append(False)
                node = self.step[at]
            # only tokens that merging itself arrives at can stand inside an encoding
            if self._merge(token) == [token]:
                self.token_at[node] = rank
        self._list_below()
        self.hypotheses, self.steps = [], {}
        self.longest = max(map(len, ranks), default=1)
        self.spines: dict[tuple[int, bool], list | None] = {}
        self.pairs: dict[int, bool] = {}            # token << 32 | next token
        self._reset()

    def _list_below(self) -> None:
        """For each inner node of at most MAX_BELOW tokens below it, those tokens; for each token,
        the ranks at which it is merged as the left part of a longer one."""
        paths, count = [], [0] * len(self.inner)
        for token, rank in self.ranks.items():
            node, path = 0, []
            for b in token[:-1]:
                node = self.step[node << 8 | b]
                path.append(node)
            node = self.step[node << 8 | token[-1]]
            if self.token_at[node] >= 0:
                paths.append((rank, path))
                for x in path:
                    count[x] += 1
        self.below: dict[int, list[int]] = {}
        for rank, path in paths:
            for x in path:
                if count[x] <= MAX_BELOW:
                    self.below.setdefault(x, []).append(rank)

    def _alike(self, last: int, node: int) -> int | None:
        """A token that stands for ``last`` at ``node``: which tokens below the node may follow is the
        same for both. -1 when all may, None when none may (the hypothesis cannot survive)."""
        below = self.below.get(node)
        if last < 0 or below is None:
            return last
        may = tuple([self.follows(last, token) for token in below])
        return -1 if all(may) else self.alike.setdefault((node, may), last) if any(may) else None

    def _reset(self) -> None:
        """Forget states and transitions; and hypotheses with their steps too once these have taken their bytes."""
        if ENTRY_BYTES * (len(self.hypotheses) + len(self.steps)) > STEP_BYTES or not self.hypotheses:
            self.hypotheses, self.hypothesis_of, self.steps, self.alike = [], {}, {}, {}
        self.states, self.ends, self.state_of, self.moves, self.same_ops = [], [], {}, {}, {}
        self._state((self._hypothesis(-1, 0),))

    def _hypothesis(self, last: int, node: int) -> int:
        key = last << 32 | node
        number = self.hypothesis_of.get(key)
        if number is None:
            number = self.hypothesis_of[key] = len(self.hypotheses)
            self.hypotheses.append((last, node))
        return number

    def _state(self, members: tuple[int, ...]) -> int:
        number = self.state_of.get(members)
        if number is None:
            number = self.state_of[members] = len(self.states)
            self.states.append(members)
            self.ends.append(next((i for i, h in enumerate(members) if not self.hypotheses[h][1]), -1))     # the one at a token's end
        return number

    def _merge(self, data: bytes, stop: int = 1) -> list[bytes]:
        """Merging by rank, the definition, down to ``stop`` parts; for the few bytes of a token or two."""
        parts, rank = [data[i:i + 1] for i in range(len(data))], self.ranks.get
        while len(parts) > stop:
            best = min(((r, i) for i in range(len(parts) - 1) if (r := rank(parts[i] + parts[i + 1])) is not None), default=None)
            if best is None:
                break
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _spine(self, token: int, right: bool) -> list[tuple[bytes, int, int]] | None:
        """The parts at the token's right (left) edge while it is merged together, as
        (bytes, rank when made, rank when merged further), whole token first. None
        when a part has a rank above that of what it is merged into: then
        ranks do not tell the order of merges."""
        key = (token, right)
        if key not in self.spines:
            part, until, out = self.bytes_of[token], 1 << 40, []
            while out is not None:
                made = self.ranks[part] if len(part) > 1 else -1
                out = out + [(part, made, until)] if made < until else None
                if len(part) == 1 or out is None:
                    break
                halves = self._merge(part, 2)
                if any(len(h) > 1 and self.ranks[h] >= made for h in halves):
                    out = None
                part, until = halves[1 if right else 0], made
            self.spines[key] = out
        return self.spines[key]

    def follows(self, a: int, b: int) -> bool:
        """Whether token b may stand after a: their bytes encode to just the two.

        Not so when some part at a's right edge and some at b's left edge, there at
        one time, make a token that is merged before either of them is merged into
        its own side (on equal ranks the left merge goes first)."""
        known = self.pairs.get(a << 32 | b)
        if known is None:
            if ENTRY_BYTES * len(self.pairs) >= PAIR_BYTES:
                self.pairs.clear()
            left, right = self._spine(a, True), self._spine(b, False)
            if left is None or right is None:
                x, y = self.bytes_of[a], self.bytes_of[b]
                known = self._merge(x + y) == [x, y]
            else:
                rank, known = self.ranks.get, True
                for p, made_p, until_p in left:
                    for q, made_q, until_q in right:
                        if made_p <= until_q and made_q < until_p:
                            r = rank(p + q)
                            if r is not None and r < until_p and r <= until_q:
                                known = False
                                break
                    if not known:
                        break
            self.pairs[a << 32 | b] = known
        return known

    def _step(self, hypothesis: int, byte: int) -> tuple[tuple[int, int], ...]:
        """What a hypothesis becomes with one more byte: (hypothesis, token appended or -1) for each."""
        last, node = self.hypotheses[hypothesis]
        child, out = self.step.get(node << 8 | byte), []
        if child is not None:
            token = self.token_at[child]
            if token >= 0 and (last < 0 or self.follows(last, token)):
                out.append((self._hypothesis(token, 0), token))
            if self.inner[child]:
                stands = self._alike(last, child)
                if stands is not None:
                    out.append((self._hypothesis(stands, child), -1))
        return tuple(out)

    def _move(self, state: int, byte: int) -> tuple[int, tuple, int]:
        """The determinised transition: (next state, for each of its hypotheses the one
        that it comes from and the token appended or -1, the one that all come from or -1)."""
        after, ops, steps = [], [], self.steps
        for i, h in enumerate(self.states[state]):
            step = steps.get(h << 8 | byte)
            if step is None:
                step = steps[h << 8 | byte] = self._step(h, byte)
            for new, token in step:
                after.append(new)
                ops.append((i, token))
        if not after:
            raise ValueError(f"byte {byte} has no token here")
        only = ops[0][0] if ops[0][0] == ops[-1][0] else -1
        ops = tuple(ops)
        return self._state(tuple(after)), self.same_ops.setdefault(ops, ops), only

    @staticmethod
    def _tokens(register: tuple | None) -> list[int]:
        """The tokens of a register: a chain (earlier tokens, last token)."""
        out = []
        while register is not None:
            register, token = register
            out.append(token)
        return out[::-1]

    def stream(self, data: Iterable[int]) -> Iterator[int]:
        """Tokens of one match, as soon as they are certain."""
        state, registers, waited, moves = 0, [None], 0, self.moves
        for b in data:
            move = moves.get(state << 8 | b)
            if move is None:
                if ENTRY_BYTES * (len(self.states) + len(moves)) > STATE_BYTES:     # begin anew from here
                    here = [self.hypotheses[h] for h in self.states[state]]
                    self._reset()
                    state, moves = self._state(tuple([self._hypothesis(*h) for h in here])), self.moves
                move = moves[state << 8 | b] = self._move(state, b)
            state, ops, only = move
            if only >= 0:
                if registers[only] is not None:
                    yield from self._tokens(registers[only])
                registers, waited = [None if token < 0 else (None, token) for _, token in ops], 0
                continue
            registers = [registers[i] if token < 0 else (registers[i], token) for i, token in ops]
            waited += 1
            if waited >= self.longest:
                each, agreed = list(map(self._tokens, registers)), 0
                while agreed < min(map(len, each)) and len({x[agreed] for x in each}) == 1:
                    agreed += 1
                yield from each[0][:agreed]
                registers, waited = [functools.reduce(lambda r, t: (r, t), x[agreed:], None) for x in each], 0
        if self.ends[state] >= 0:
            yield from self._tokens(registers[self.ends[state]])

    def encode(self, data: bytes) -> list[int]:
        """Tokens of one match. One no longer than the longest token need not be emitted on the way: its
        transitions are kept instead of registers and followed back from the hypothesis it ends in."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) > self.longest or ENTRY_BYTES * (len(self.states) + len(self.moves)) > STATE_BYTES:
            return list(self.stream(data))
        state, trail, moves = 0, [], self.moves
        for b in data:
            move = moves.get(state << 8 | b)
            if move is None:
                move = moves[state << 8 | b] = self._move(state, b)
            state, ops, _ = move
            trail.append(ops)
        out, i = [], self.ends[state]
        for ops in reversed(trail):
            i, token = ops[i]
            if token >= 0:
                out.append(token)
        return out[::-1]


class Pieces(dict):
    """Encoded matches: match -> its tokens as 32-bit integers. When half the bytes are
    taken the matches become the older half, those not asked for since then are dropped."""

    def __init__(self, encoder: Encoder):
        self.encoder, self.taken, self.older = encoder, 0, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = array("i", self.encoder.encode(piece.encode("utf-8"))).tobytes()
        if len(piece) <= LONG_PIECE:
            if 2 * self.taken > PIECE_BYTES:
                self.older = dict(self)
                self.clear()
                self.taken = 0
            self[piece] = ids
            self.taken += 180 + len(piece) + len(ids)
        return ids


class Utf8Stream:
    """Incremental UTF-8 state machine over the bytes of tokens.

    A state is the incomplete character so far. What a token does in a state is
    worked out once per (state, token).
    """

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of, self.done = bytes_of, {}
        size = max(bytes_of, default=-1) + 1
        self.plain: list[str | None] = [None] * size     # tokens of whole characters, in the start state
        for t in bytes_of:
            text, rest = self.feed(b"", t)
            self.plain[t] = None if rest or "�" in text else text

    @staticmethod
    def _room(head: bytes) -> tuple[int, int, int] | None:
        """(bytes missing, least and largest next byte) after ``head``; None when malformed (Unicode table 3-7)."""
        lead, n = head[0], len(head)
        if lead < 0x80:
            need = 0
        elif 0xC2 <= lead <= 0xDF:
            need = 1
        elif 0xE0 <= lead <= 0xEF:
            need = 2
        elif 0xF0 <= lead <= 0xF4:
            need = 3
        else:
            return None
        low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80) if n == 1 else 0x80
        high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, 0xBF) if n == 1 else 0xBF
        return need + 1 - n, low, high

    def feed(self, state: bytes, token: int) -> tuple[str, bytes]:
        """(characters completed, next state)."""
        known = self.done.get((state, token))
        if known is not None:
            return known
        out, head = [], state
        for b in self.bytes_of[token]:
            if head:
                missing, low, high = self._room(head)
                if low <= b <= high:
                    head += bytes([b])
                    if missing == 1:
                        out.append(head.decode("utf-8"))
                        head = b""
                    continue
                out.append("�")
                head = b""
            room = self._room(bytes([b]))
            if room is None:
                out.append("�")
            elif room[0] == 0:
                out.append(chr(b))
            else:
                head = bytes([b])
        self.done[state, token] = known = ("".join(out), head)
        return known

    def decode(self, tokens: Iterable[int]) -> str:
        try:
            return "".join(map(self.plain.__getitem__, tokens))
        except TypeError:       # a token with a part of a character: walk the states
            state, out = b"", []
            for t in tokens:
                text = self.plain[t] if not state else None
                if text is None:
                    text, state = self.feed(state, t)
                out.append(text)
            return "".join(out) + ("�" if state else "")


class Codec:
    """Splitting, encoding and decoding in one worker."""

    def __init__(self, raw: bytes, pattern: str):
        self.encoder = Encoder(read_ranks(raw))
        self.decoder = Utf8Stream(self.encoder.bytes_of)
        self.split, self.pieces = splitter(pattern), Pieces(self.encoder)

    @staticmethod
    def of(raw: bytes, pattern: str) -> Codec:
        return held(("bpe", hash((raw, pattern))), lambda: Codec(raw, pattern))

    def encode_bytes(self, text: str) -> bytes:
        """The tokens of a text as 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), np.int32).tolist()


def vocabulary(spark: SparkSession, path: str | None = None) -> Broadcast:
    """A rank file's content for the executors (a vocabulary: under 1 MB, of a size that does not grow)."""
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(text: Column, ranks: Broadcast, pattern: str = public_tokenizers.PATTERN, decoded: bool = False) -> Column:
    """array<int>: the token ids of the whole text. With ``decoded`` struct(ids, decoded), the ids and
    what they decode to as a stream, from one pass (a second function over the ids would encode again)."""
    @F.arrow_udf("struct<ids array<int>, decoded string>" if decoded else "array<int>")
    def run(texts: pa.Array) -> pa.Array:
        codec = Codec.of(ranks.value, pattern)
        each = [codec.encode_bytes(t or "") for t in texts.to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in each])]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(each), np.int32)))
        if not decoded:
            return ids
        back = [codec.decoder.decode(np.frombuffer(x, np.int32).tolist()) for x in each]
        return pa.StructArray.from_arrays([ids, pa.array(back, pa.string())], ["ids", "decoded"])

    return run(text)


def decode(ids: Column, ranks: Broadcast, pattern: str = public_tokenizers.PATTERN) -> Column:
    """string: the ids of ``ids`` (array<int>) decoded as a stream."""
    @F.arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        stream = Codec.of(ranks.value, pattern).decoder
        return pa.array([stream.decode(x.values.to_numpy().tolist()) if x.is_valid else None for x in lists], pa.string())

    return run(ids)


def bpe_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of the ids and of what they decode to."""
    spark = docs.sparkSession
    arrow_batches(spark)
    each = docs.select("doc_id", encode(whole_text(F.col("text")), vocabulary(spark, path), decoded=True).alias("t"))
    return each.select("doc_id", F.size("t.ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("t.ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("t.decoded", 256).alias("decoded_sha256"))
