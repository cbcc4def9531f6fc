"""Token counts by a compiled finite-state transducer.

The vocabulary of a byte-fallback piece BPE is compiled into a deterministic
transducer over characters, state by state as texts need them. Its state after a
prefix holds all that later characters can ask for: for each suffix of the prefix
that may still grow into a longer piece, the last token before that suffix and how
many tokens lie between. A transition carries the change of the token count. That
the last token follows from these is a property of BPE: a token sequence is the
encoding of its text if and only if every adjacent pair is the encoding of its own.

No piece holds a space behind another character, and a character outside the
alphabet becomes byte tokens that never merge. At both the transducer is back in
its start state, whatever came before; segments between two such points that were
seen before are taken from a bounded memo.

A long text is cut into chunks, which are rows of their own, dealt over all tasks. Each
becomes a state map: from any entry state to the exit state and the tokens counted. A map
is kept as the run from the start state and, for its first characters, the states on the
way: a run from another entry state goes on only until it meets that run, from where on
both are the same. Maps compose associatively; a document's maps are folded pairwise, level
by level, as in a parallel prefix scan.

Defined results: null counts as empty (0 bytes, 0 tokens); repeated rows each give a
row; other columns are ignored whatever their names; an empty table stays empty.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import cut, map_texts, pieces

FIELDS = {"n_bytes": pa.int64(), "n_tokens": pa.int64()}
SPACE = "▁"
#: Characters of a chunk, and of the longest text that isn't cut.
CHUNK, WHOLE = 1 << 15, 1 << 16


#: A state as all workers know it: for each still growing suffix (suffix, last token before it, tokens since), and the last token.
State = tuple[tuple[tuple[str, str, int], ...], str]
#: A state, and the tokens up to there.
Met = tuple[State, int]
START: State = ((), "")


class Part(NamedTuple):
    """One chunk: whether it begins and ends with a space, the characters before its first point, what the run from the
    start state met on them, its state and count behind them, and the state and tokens behind the rest, if there is one."""

    begins: bool
    ends: bool
    head: str
    met: tuple[Met, ...]
    state: State
    count: int
    exit: State | None = None
    tokens: int = 0


class ChunkMap(NamedTuple):
    """The state map of neighbouring chunks: the parts, and where the run from the start state is behind each."""

    parts: list[Part]
    exits: list[Met]


class Memo(dict):
    """Composed maps of segments, from start state to start state, emptied when full."""

    def __init__(self, run: Callable[[str], int], most: int) -> None:
        self.run, self.most = run, most

    def __missing__(self, segment: str) -> int:
        n = self.run(segment.replace(" ", SPACE))
        if len(segment) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[segment] = n
        return n


class PieceTransducer:
    """``ranks``: pieces with their merge ranks, lower first; all other characters fall back to bytes."""

    #: Segments whose composed maps are kept at a time.
    MEMO = 400_000
    #: States that are kept compiled at a time; beyond, compilation starts anew.
    STATES = 300_000
    #: Characters of a chunk for which a map holds the states on the way.
    MET = 64

    def __init__(self, ranks: dict[str, int]) -> None:
        if any(SPACE in piece.lstrip(SPACE) for piece in ranks):
            raise ValueError("a piece holds a space behind another character")
        self.ranks = ranks
        self.alphabet = {c for piece in ranks for c in piece}
        if not all(c in ranks for c in self.alphabet):
            raise ValueError("a character of the vocabulary is no piece")
        self.growing = {piece[:k] for piece in ranks for k in range(1, len(piece))}
        self.longest = max(map(len, ranks))
        self.memo = Memo(self.run, self.MEMO)
        self.start()
        self.points = re.compile("(?<=[^ ]) " if "\n" in self.alphabet else "(?<=[^ ]) |\n").search
        gap = "" if "\n" in self.alphabet else "\n"
        self.segments = re.compile(f" *[^ {gap}]+| +" + (f"|{gap}" if gap else "")).findall

    @classmethod
    def from_sentencepiece(cls, path: str) -> PieceTransducer:
        """From a BPE model with byte fallback and no text normalisation but the leading space."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
        return cls({model.id_to_piece(i): -model.get_score(i) for i in ids if not special(i)})

    def start(self) -> None:
        """Nothing compiled yet but the start state."""
        #: A state: for each still growing suffix, longest first, (suffix, last token before it, tokens since).
        self.states: list[tuple[tuple[str, str, int], ...]] = [()]
        self.lasts: list[str] = [""]
        self.numbers: dict[tuple, int] = {((), ""): 0}
        #: By state, then character: (next state, change of the count).
        self.moves: list[dict[str, tuple[int, int]]] = [{}]
        self.pairs: dict[tuple[str, str], bool] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """Plain BPE, for two tokens at most: the lowest rank merges first, the leftmost of equals."""
        while len(symbols) > 1:
            options = [(self.ranks.get(a + b, None), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))]
            options = [x for x in options if x[0] is not None]
            if not options:
                break
            i = min(options)[1]
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        return symbols

    def fits(self, left: str, right: str) -> bool:
        """Whether the two stand beside each other in the encoding of their text; without a left one, whether right is its own."""
        known = self.pairs.get((left, right))
        if known is None:
            known = self.pairs[left, right] = self.merged(list(left + right)) == [left, right] if left else self.merged(list(right)) == [right]
        return known

    def number(self, state: tuple, last: str) -> int:
        key = (state, last)
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(state)
            self.lasts.append(last)
            self.moves.append({})
        return self.numbers[key]

    def compile_move(self, k: int, c: str) -> tuple[int, int]:
        """The transition of state k on a character of the alphabet."""
        state, last = self.states[k], self.lasts[k]
        # Every suffix that can end in a token or grow further, with what precedes it.
        options = [(suffix + c, before, since) for suffix, before, since in state] + [(c, last, 0)]
        token, change = next(
            (piece, 1 - since)
            for piece, before, since in options
            if piece in self.ranks and self.fits(before, piece)
        )
        grown = tuple((s, before, since + change) for s, before, since in options if s in self.growing)
        move = self.moves[k][c] = (self.number(grown, token), change)
        return move

    def run(self, segment: str) -> int:
        """Tokens of a segment from the start state; spaces are written as the piece's space."""
        if len(self.states) > self.STATES:
            self.start()
        state, count, moves = 0, 0, self.moves
        for c in segment:
            move = moves[state].get(c)
            if move is None:
                if c not in self.alphabet:
                    count += len(c.encode())
                    state = 0
                    continue
                move = self.compile_move(state, c)
            state = move[0]
            count += move[1]
        return count

    def count_segments(self, text: str) -> int:
        """Tokens of a text that begins and ends at points where the transducer is in its start state."""
        return sum(map(self.memo.__getitem__, self.segments(text)))

    def key(self, k: int) -> State:
        return self.states[k], self.lasts[k]

    def walk(self, entry: State, segment: str, beside: list[Met] = ()) -> tuple[State, int, int]:
        """From an entry state over a stretch without a point: the state and the count where the walk ends, and how
        many characters it took, which are all unless it comes to one of the states ``beside`` after as many."""
        state, count = self.number(*entry), 0
        for at, c in enumerate(segment):
            if at < len(beside) and self.key(state) == beside[at][0]:
                return self.key(state), count, at
            move = self.moves[state].get(c)
            if move is None and c not in self.alphabet:
                count += len(c.encode())
                state = 0
                continue
            state, change = move or self.compile_move(state, c)
            count += change
        return self.key(state), count, len(segment)

    def chunk_map(self, chunk: str) -> ChunkMap:
        """The state map of a chunk, which isn't empty."""
        if len(self.states) > self.STATES:
            self.start()
        first = self.points(chunk)
        head = (chunk[: first.start()] if first else chunk).replace(" ", SPACE)
        met, state, count = [], START, 0
        for at in range(0, min(len(head), self.MET)):
            met.append((state, count))
            state, more, _ = self.walk(state, head[at])
            count += more
        state, more, _ = self.walk(state, head[len(met) :])
        part = Part(chunk[0] == " ", chunk[-1] == " ", head, tuple(met), state, count + more)
        if first:
            space = chunk.rfind(" ")
            while space > 0 and chunk[space - 1] == " ":  # a run of spaces begins one segment
                space -= 1
            last = max(first.start(), space, -1 if "\n" in self.alphabet else chunk.rfind("\n"))
            tail, tokens, _ = self.walk(START, chunk[last:].replace(" ", SPACE))
            part = part._replace(exit=tail, tokens=self.count_segments(chunk[first.start() : last]) + tokens)
        return ChunkMap([part], [self.through(part, START)])

    def through(self, part: Part, entry: State) -> tuple[State, int]:
        """The exit state and the count of one chunk from an entry state."""
        state, count, at = self.walk(entry, part.head, part.met)
        if at < len(part.head):  # met the run from the start state
            state, count = part.state, count + part.count - part.met[at][1]
        return (state, count) if part.exit is None else (part.exit, count + part.tokens)

    def apply(self, chunks: ChunkMap, entry: State, space: bool) -> list[Met]:
        """The state and the count behind each chunk, from an entry state and whether a space is before it."""
        state, total, out = entry, 0, []
        for n, part in enumerate(chunks.parts):
            if part.begins and not space:
                state = START
            state, count = self.through(part, state)
            total += count
            out.append((state, total))
            known, upto = chunks.exits[n]
            if state == known:  # from here on the run from the start state
                return out + [(s, c + total - upto) for s, c in chunks.exits[n + 1 :]]
            space = part.ends
        return out

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        state, count = a.exits[-1]
        behind = self.apply(b, state, a.parts[-1].ends)
        return ChunkMap(a.parts + b.parts, a.exits + [(s, c + count) for s, c in behind])

    def fold(self, maps: list[ChunkMap]) -> int:
        """The tokens of a whole text from the maps of its chunks."""
        while len(maps) > 1:
            pairs = [self.compose(*maps[i : i + 2]) for i in range(0, len(maps) - 1, 2)]
            maps = pairs + maps[len(pairs) * 2 :]
        return maps[0].exits[-1][1] if maps else 0

    def count(self, text: str | None) -> int:
        """Tokens of a text in one run, for texts that aren't cut."""
        return self.count_segments(prepared(text)) if text else 0


def prepared(text: str) -> str:
    """The text as the transducer reads it; the piece's own space is a space, too."""
    return " " + text.replace(SPACE, " ")


@cache
def machine_of(model_path: str) -> PieceTransducer:
    """One transducer for all tasks of a Python worker, which go on with what is compiled."""
    return PieceTransducer.from_sentencepiece(model_path)


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_bytes`` of UTF-8 and ``n_tokens``.

    Texts of at most WHOLE characters are counted in one map stage without a shuffle. Longer ones
    are cut into chunk rows, mapped in parallel, and folded in a group for each text, which holds
    its maps. The compiled transducer, bounded by the vocabulary and its memo, lives in each
    Python worker; ``model_path`` must be readable there.
    """

    def worker() -> Callable[[list], dict[str, list]]:
        machine = machine_of(model_path)

        def kernel(texts: list) -> dict[str, list]:
            return {"n_bytes": [len((t or "").encode()) for t in texts], "n_tokens": [machine.count(t) for t in texts]}

        return kernel

    def chunk_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = machine_of(model_path)
        for batch in batches:
            for start, end in pieces(batch.column(4)):
                some = batch.slice(start, end - start)
                blobs = [pickle.dumps([*map(tuple, machine.chunk_map(c).parts)]) for c in some.column(4).to_pylist()]
                yield pa.RecordBatch.from_arrays([*some.columns[:4], pa.array(blobs, pa.binary())], ["row", "id", "n_bytes", "no", "map"])

    def fold(table: pa.Table) -> pa.Table:
        machine = machine_of(model_path)
        blobs = sorted(zip(table.column("no").to_pylist(), table.column("map").to_pylist()))
        parts = [Part(*fields) for _, blob in blobs for fields in pickle.loads(blob)]
        maps = [ChunkMap([part], [machine.through(part, START)]) for part in parts]
        first = table.slice(0, 1)
        return pa.table({id_col: first.column("id"), "n_bytes": first.column("n_bytes"), "n_tokens": pa.array([machine.fold(maps)], pa.int64())})

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    is_long = F.coalesce(F.length("text"), F.lit(0)) > WHOLE
    short = map_texts(slim.filter(~is_long), ["id"], "text", FIELDS, worker).withColumnRenamed("id", id_col)
    read_as = F.concat(F.lit(" "), F.translate("text", SPACE, " "))
    # Written, so that rows keep their numbers whatever is lost behind them.
    chunks = cut(
        slim.filter(is_long)
        .withColumn("row", F.monotonically_increasing_id())
        .select("row", "id", F.octet_length("text").cast("long").alias("n_bytes"), F.posexplode(F.regexp_extract_all(read_as, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))).alias("no", "chunk"))
    )
    id_type = slim.schema["id"].dataType.simpleString()
    maps = chunks.repartition("row", "no").mapInArrow(chunk_maps, f"row long, id {id_type}, n_bytes long, no int, map binary")
    folded = maps.groupBy("row").applyInArrow(fold, f"`{id_col}` {id_type}, n_bytes long, n_tokens long")
    return short.unionByName(folded)


def over_limit(counted: DataFrame, limit: int) -> DataFrame:
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
