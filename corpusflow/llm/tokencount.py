"""Token counts by a finite-state transducer compiled from a BPE vocabulary.

The merges of a BPE vocabulary have a local property: a sequence of tokens is
the encoding of a text exactly if every two neighbours are the encoding of
their joined text. So the last token of the encoding of every prefix can be
found from the last tokens of shorter prefixes, no farther back than the longest
token. That is a finite state: for each place where a token may still be
unfinished, the node of the vocabulary's trie that has been reached, the token
that ends at the place, and the number of tokens up to it, counted from the
oldest such place. A character takes one state to the next and emits by how
much the oldest place moved on in tokens: a deterministic transducer with
emitted-token counts on its transitions and a rest at the end. States are built
when a text first reaches them.

Two rules bring the transducer back to its start whatever came before: a
character outside the vocabulary (it counts its UTF-8 bytes), and a space mark
after another character, where no token has one inside. A text is cut into
chunks. The state map of a chunk says what its characters before the first such
place are (they act on the state that enters), how many tokens lie between the
first and the last such place, and which state leaves. These maps compose
associatively, and a prefix scan over the chunks in log n rounds gives the
count. All parts of a row lie in its task: nothing is shuffled.

Cases: a null or empty text has no tokens. Special strings in a text are text.
Repeated rows are counted row by row. An empty table gives an empty result.
Further columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_blocks

#: The character that stands for a space in the vocabulary.
MARK = "▁"
#: Characters of a chunk, and of text that a task reads at once.
CHUNK_CHARS = 1 << 15
BLOCK_CHARS = 4_000_000
#: Units and states that a task remembers before it starts anew.
REMEMBERED_UNITS = 1_000_000
REMEMBERED_STATES = 400_000
TOKEN_LIMIT = 4096


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores, greatest first to merge; other characters fall back to bytes."""

    scores: dict[str, float]
    leading_mark: bool

    @staticmethod
    def from_model(path: str) -> Vocabulary:
        """From a ``sentencepiece`` BPE model with byte fallback and without a normaliser."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [
            i
            for i in range(model.get_piece_size())
            if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))
        ]
        leading = model.encode("a", out_type=str)[0].startswith(MARK)
        return Vocabulary({model.id_to_piece(i): model.get_score(i) for i in ids}, leading)


class Transducer:
    """The compiled vocabulary; states and transitions are added on demand."""

    def __init__(self, vocabulary: Vocabulary):
        self.scores = vocabulary.scores
        self.alphabet = {c for piece in self.scores for c in piece}
        # trie: children by character, and the piece that ends at a node
        self.children: list[dict[str, int]] = [{}]
        self.piece: list[str | None] = [None]
        for piece in self.scores:
            node = 0
            for c in piece:
                following = self.children[node].get(c)
                if following is None:
                    following = self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.piece.append(None)
                node = following
            self.piece[node] = piece
        self.mark_inside = any(MARK in piece.lstrip(MARK) for piece in self.scores)
        self.joins: dict[tuple[str | None, str], bool] = {}
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: list[dict[str, tuple[int, int]]] = []
        self.rests: list[int] = []
        self.after_mark: list[bool] = []
        self.units: dict[str, int] = {}
        self.start = self._number(((0, None, 0),), True)

    def _number(self, live: tuple, after_mark: bool) -> int:
        key = (live, after_mark)
        found = self.numbers.get(key)
        if found is None:
            found = self.numbers[key] = len(self.states)
            self.states.append(live)
            self.moves.append({})
            self.rests.append(live[-1][2])
            self.after_mark.append(after_mark)
        return found

    def _merged(self, text: str) -> list[str]:
        """Tokens of a short text by the merges themselves."""
        parts = list(text)
        while len(parts) > 1:
            ranked = [(-self.scores[a + b], i) for i, (a, b) in enumerate(pairwise(parts)) if a + b in self.scores]
            if not ranked:
                break
            _, at = min(ranked)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _joins(self, left: str | None, right: str) -> bool:
        """Whether the tokens stand side by side in the encoding of their joined text."""
        found = self.joins.get((left, right))
        if found is None:
            wanted = [right] if left is None else [left, right]
            found = self.joins[left, right] = self._merged("".join(wanted)) == wanted
        return found

    def step(self, state: int, c: str) -> tuple[int, int]:
        """(next state, emitted tokens)."""
        found = self.moves[state].get(c)
        if found is None:
            found = self.moves[state][c] = self._compile(state, c)
        return found

    def _compile(self, state: int, c: str) -> tuple[int, int]:
        if c not in self.alphabet:
            return self.start, self.rests[state] + len(c.encode("utf-8"))
        if self.resets(state, c):
            following, emitted = self.step(self.start, c)
            return following, emitted + self.rests[state]
        live, last = [], None
        for node, token, count in self.states[state]:
            reached = self.children[node].get(c)
            if reached is None:
                continue
            if self.children[reached]:
                live.append((reached, token, count))
            piece = self.piece[reached]
            if piece is not None and last is None and self._joins(token, piece):
                last = (piece, count + 1)
        if last is None:
            raise ValueError(f"the vocabulary has no token for {c!r} here")
        live.append((0, *last))
        base = live[0][2]
        return self._number(tuple((n, t, k - base) for n, t, k in live), c == MARK), base

    def resets(self, state: int, c: str) -> bool:
        return c == MARK and not self.after_mark[state] and not self.mark_inside

    def run(self, state: int, text: str) -> tuple[int, int]:
        """State and tokens after ``text``, entered in ``state``."""
        total, moves = 0, self.moves
        for c in text:
            move = moves[state].get(c)
            if move is None:
                move = self.step(state, c)
            state = move[0]
            total += move[1]
        return state, total

    def unit(self, text: str) -> int:
        """Tokens of a text between two places where the transducer is at its start."""
        state, total = self.run(self.start, text)
        total += self.rests[state]
        self.units[text] = total
        return total


@dataclass
class StateMap:
    """What a chunk does to the state that enters it.

    ``head`` acts on that state. If ``closed``, it leads to the start; then come
    ``tokens``, and ``leaves`` is the state at the end. If not, the head is all.
    """

    head: str
    closed: bool = False
    tokens: int = 0
    leaves: int = 0


def _units(pieces: Iterable[str]) -> str:
    """Pattern of units: texts between places that no piece reaches across.

    Such places lie before a space mark that does not follow another, on both
    sides of control characters outside the vocabulary, and before ASCII
    punctuation that no piece has behind an ASCII letter or digit, unless the
    character before is one of those that some piece does have there.
    """
    before: dict[str, set[str]] = defaultdict(set)
    for piece in pieces:
        before[piece[0]].add(MARK)
        for a, b in pairwise(piece):
            before[b].add(a)
    if before[MARK] - {MARK}:
        return r"(?s).+"
    marks = {
        c for c in before
        if c.isascii() and not c.isalnum() and not any(x.isascii() and x.isalnum() for x in before[c])
    }
    tied = set().union(*(before[c] for c in marks)) | marks | {MARK}
    outside = "".join(re.escape(c) for c in "\n\r\t" if c not in before)
    first = "".join(map(re.escape, sorted(marks)))
    rest = f"[^{MARK}{first}{outside}]"
    if first:
        rest = f"(?:{rest}|(?<=[{''.join(map(re.escape, sorted(tied)))}])[{first}])"
    begin = f"(?:{MARK}+|[^{MARK}{outside}])"
    return f"{begin}{rest}*" + (f"|[{outside}]" if outside else "")


class Counter:
    """Counts tokens of texts with one transducer."""

    def __init__(self, vocabulary: Vocabulary):
        self.machine = Transducer(vocabulary)
        self.leading_mark = vocabulary.leading_mark
        self.cut = re.compile(_units(vocabulary.scores))

    def state_map(self, chunk: str) -> StateMap:
        units = self.cut.findall(chunk)
        # where the first unit begins depends on what enters; all others begin at the start
        if len(units) < 2:
            return StateMap(chunk)
        known, machine = self.machine.units, self.machine
        tokens = 0
        for unit in units[1:-1]:
            count = known.get(unit)
            tokens += machine.unit(unit) if count is None else count
        leaves, more = machine.run(machine.start, units[-1])
        return StateMap(units[0], True, tokens + more, leaves)

    def compose(self, a: StateMap, b: StateMap) -> StateMap:
        """First ``a``, then ``b``; associative."""
        machine = self.machine
        if not a.closed:
            return StateMap(a.head + b.head, b.closed, b.tokens, b.leaves)
        state, emitted = machine.run(a.leaves, b.head)
        if not b.closed:
            return StateMap(a.head, True, a.tokens + emitted, state)
        return StateMap(a.head, True, a.tokens + emitted + machine.rests[state] + b.tokens, b.leaves)

    def scan(self, maps: list[StateMap]) -> list[StateMap]:
        """Inclusive prefix scan in log n rounds; within a round the compositions are independent."""
        reach = 1
        while reach < len(maps):
            maps = [self.compose(maps[i - reach], m) if i >= reach else m for i, m in enumerate(maps)]
            reach *= 2
        return maps

    def count(self, text: str, chunk_chars: int = CHUNK_CHARS) -> int:
        if not text:
            return 0
        machine = self.machine
        if len(machine.units) > REMEMBERED_UNITS or len(machine.states) > REMEMBERED_STATES:
            machine.forget()
        text = (MARK if self.leading_mark else "") + text.replace(" ", MARK)
        maps = [self.state_map(text[at : at + chunk_chars]) for at in range(0, len(text), chunk_chars)]
        whole = self.scan(maps)[-1]
        state, tokens = machine.run(machine.start, whole.head)
        if whole.closed:
            return tokens + machine.rests[state] + whole.tokens + machine.rests[whole.leaves]
        return tokens + machine.rests[state]


@lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    return Counter(Vocabulary.from_model(path))


def token_counts(docs: DataFrame, model: str, text_col: str = "text", limit: int = TOKEN_LIMIT, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row.

    ``model`` is the path of a ``sentencepiece`` BPE model that every executor
    can read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model)
        for doc_ids, n_bytes, texts in text_blocks(batches, BLOCK_CHARS, "doc_id", "n_bytes", "text"):
            counts = [counter.count(text, chunk_chars) for text in texts]
            columns = [pa.array(values, pa.int64()) for values in (doc_ids, n_bytes, counts)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select("doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("text"))
    counted = rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
