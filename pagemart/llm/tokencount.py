"""Token counts of a sentence-piece BPE model from a compiled finite-state transducer.

The model's merges are compiled, state by state as texts need them, into a
deterministic transducer over characters. A state holds, for each position of
the text at which a piece may still be open, the open piece's characters, the
token before it and how many tokens the text up to there has, relative to the
newest position; so each transition has one fixed count of emitted tokens (it
may be negative, when a longer piece replaces several). The count of a text is
the sum along its path.

Where two neighbouring characters occur together in no piece, no token spans
them and the state forgets what lies before. A chunk of a text is therefore a
short map of states: the characters before its first such cut, for which the
start state matters, the tokens counted from there, and the characters since its
last cut, which determine the end state. Maps of neighbouring chunks compose
associatively; long texts are counted chunk by chunk and composed pairwise, as a
parallel prefix scan does. Texts that are stored as rows of chunks are composed by
rounds of bounded groups of neighbours, so no task holds all chunks of a text. A
stretch without a cut, such as a run of one letter, is carried in the map as it is.

Cases: null and empty texts have no tokens; texts of any length are counted
whole; repeated rows are counted each; an input column that has the name of an
output column is replaced by it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemart.llm.shared import quoted, stored
from pagemart.operators.lineage import numbered

#: States are dropped, and compiled again as needed, when there are this many.
MAX_STATES, MAX_PAIRS = 200_000, 200_000
#: Stretches between two cuts whose counts are remembered, of at most so many characters.
MAX_STRETCHES, STRETCH = 300_000, 48
#: Characters of a chunk; maps that are composed in one group.
CHUNK, FOLD = 65_536, 256
#: The token before a cut.
CUT = ""
#: Marks and what follows them, or what comes before the first mark.
STRETCHES = re.compile("▁+[^▁]*|[^▁]+").findall


class State(dict):
    """Transitions: character -> (state, tokens emitted). Missing ones are compiled."""

    __slots__ = ("machine", "previous", "open")

    def __init__(self, machine: Transducer, previous: str, opened: tuple):
        self.machine, self.previous, self.open = machine, previous, opened

    def __missing__(self, char: str) -> tuple[State, int]:
        step = self[char] = self.machine.compile(self, char)
        return step


class Transducer:
    """scores: a piece's score; merges of higher score come first, then the leftmost."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.prefixes = {p[:i] for p in scores for i in range(1, len(p) + 1)}
        self.together = {p[i : i + 2] for p in scores for i in range(len(p) - 1)}
        self._pairs: dict[tuple[str, str], bool] = {}
        self._halves: dict[str, list[str] | None] = {}
        self._counts: dict[str, int] = {}
        self._older: dict[str, int] = {}
        #: Texts can be taken apart before marks, if no piece has a mark behind another character.
        self.apart = not any(pair[1] == "▁" != pair[0] for pair in self.together)
        self.states: dict[tuple, State] = {}
        self.start = self.state("", ((CUT, CUT, 0),))

    def state(self, previous: str, opened: tuple) -> State:
        key = (previous, opened)
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = State(self, previous, opened)
        return found

    def merge(self, text: str, until: int = 1) -> list[str]:
        """The merges as defined, until so many parts are left; for short texts."""
        parts = list(text)
        while len(parts) > until:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: str) -> list[str] | None:
        """The two parts whose merge makes this piece; None for a character."""
        if token not in self._halves:
            self._halves[token] = self.merge(token, 2) if len(token) > 1 else None
        return self._halves[token]

    def fits(self, left: str, right: str) -> bool:
        """Whether right may follow left; anything that merges to itself may follow a cut.

        The parts of left and right that touch at the border are taken from the
        finished tokens backwards, that of lower score first, as it was made
        later. A pair of them that merges before either grows on its own side
        rules the two tokens out. Equal scores are decided by the definition.
        """
        scores = self.scores
        if not left:
            return self.merge(right) == [right]
        a, b, into_a, into_b = left, right, float("-inf"), float("-inf")
        while True:
            across = scores.get(a + b)
            if across is not None and across in (into_a, into_b):
                return self.merge(left + right) == [left, right]
            if across is not None and across > into_a and across > into_b:
                return False
            of_a, of_b = self.halves(a), self.halves(b)
            if of_a and (not of_b or scores[a] < scores[b]):
                into_a, a = scores[a], of_a[1]
            elif of_b:
                into_b, b = scores[b], of_b[0]
            else:
                return True

    def weight(self, token: str) -> int:
        """A piece is one token, a character that is no piece one per byte."""
        return 1 if token in self.scores else len(token.encode("utf-8", "surrogatepass"))

    def compile(self, state: State, char: str) -> tuple[State, int]:
        opened = state.open
        if state.previous + char not in self.together:
            opened = ((CUT, CUT, 0),)
        last, count, still = None, 0, []
        for begun, before, tokens in opened:
            now = begun + char
            if last is None and (now in self.scores or not begun):
                known = self._pairs.get((before, now))
                if known is None:
                    if len(self._pairs) >= MAX_PAIRS:
                        self._pairs.clear()
                    known = self._pairs[before, now] = self.fits(before, now)
                if known:
                    last, count = now, tokens + self.weight(now)
            if now in self.prefixes:
                still.append((now, before, tokens))
        still.append((CUT, last, 0))
        moved = tuple((begun, before, tokens - count if begun else 0) for begun, before, tokens in still)
        return self.state(char, moved), count

    def run(self, state: State, text: str) -> tuple[State, int]:
        count = 0
        for char in text:
            state, emitted = state[char]
            count += emitted
        return state, count

    def trim(self) -> None:
        """Call between texts or chunks only: states in use are dropped too."""
        if len(self.states) > MAX_STATES:
            for state in self.states.values():
                state.clear()
            self.states.clear()
            self.start = self.state("", ((CUT, CUT, 0),))

    def chunk_map(self, chunk: str) -> tuple[str, bool, int, str]:
        """(characters before the first cut, whether there is one, tokens behind it,
        characters since the last cut).
        """
        first = next((i for i in range(1, len(chunk)) if chunk[i - 1 : i + 1] not in self.together), 0)
        if not first:
            return chunk, False, 0, chunk
        at = next(i for i in range(len(chunk) - 1, 0, -1) if chunk[i - 1 : i + 1] not in self.together)
        return chunk[:first], True, self.run(self.start, chunk[first:])[1], chunk[at:]

    def compose(self, left: tuple, right: tuple) -> tuple:
        """The map of two neighbouring chunks; associative."""
        head, cut, count, tail = left
        head2, cut2, count2, tail2 = right
        if not head and not cut:
            return right
        if not head2 and not cut2:
            return left
        if not cut:
            # Whether the border is a cut, the joined head shows.
            if tail[-1:] + head2[:1] in self.together:
                return head + head2, cut2, count2, tail2 if cut2 else head + head2
            return head, True, self.run(self.start, head2)[1] + count2, tail2 if cut2 else head2
        state, before = self.run(self.start, tail)
        after = self.run(state, head2)[1]
        if not cut2:
            tail2 = tail + head2 if tail[-1:] + head2[:1] in self.together else head2
        return head, True, count + after + count2, tail2

    def total(self, whole: tuple) -> int:
        """The count of a text whose map is whole."""
        return self.run(self.start, whole[0])[1] + whole[2]

    def short(self, text: str) -> int:
        """The sum over stretches between cuts; counts of frequent ones are remembered."""
        if not self.apart:
            return self.run(self.start, text)[1]
        total = 0
        for stretch in STRETCHES(text):
            count = self._counts.get(stretch)
            if count is None:
                count = self._older.get(stretch)
                if count is None:
                    count = self.run(self.start, stretch)[1]
                if len(stretch) <= STRETCH:
                    if len(self._counts) >= MAX_STRETCHES:
                        self._older, self._counts = self._counts, {}
                    self._counts[stretch] = count
            total += count
        return total

    def count(self, text: str) -> int:
        """The count of prepared text."""
        if len(text) <= CHUNK:
            return self.short(text)
        maps = []
        for i in range(0, len(text), CHUNK):
            self.trim()
            maps.append(self.chunk_map(text[i : i + CHUNK]))
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return self.total(maps[0])


def prepared(text: str | None) -> str:
    """As the model's identity normaliser does: a mark before the text and for each space."""
    return "▁" + text.replace(" ", "▁") if text else ""


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """Compiled from a model file; one per process."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return Transducer({model.id_to_piece(i): model.get_score(i) for i in plain})


def token_count(text: Column, path: str) -> Column:
    """The number of tokens (long) of whole texts."""

    @F.pandas_udf("long")
    def count_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = transducer(path)
        for texts in batches:
            counts = []
            for text in texts:
                machine.trim()
                counts.append(machine.count(prepared(text)))
            yield pd.Series(counts, index=texts.index, dtype="int64")

    return count_texts(F.coalesce(text, F.lit("")))


def with_token_counts(df: DataFrame, path: str, limit: int, text_col: str = "text") -> DataFrame:
    """df with n_bytes, n_tokens and over_limit (n_tokens > limit)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (
        df.withColumn("n_tokens", token_count(F.col(text_col), path))
        .withColumn("n_bytes", F.octet_length(text).cast("long"))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )


def count_chunked(chunks: DataFrame, path: str, key: str, order: str, text_col: str = "text") -> DataFrame:
    """(key, n_tokens) of texts stored as rows of consecutive chunks.

    Each chunk becomes its map where it lies. Maps are numbered in the order of
    texts and chunks, and each round composes runs of FOLD neighbours of one text,
    until no text has more than one; so a text of any number of chunks is spread
    over tasks. A map is as long as the stretches before its first and after its
    last cut, some characters in prose. Null chunks are empty ones; null keys are
    one key; chunks of one place come in any order.
    """

    @F.pandas_udf("head string, cut boolean, tokens long, tail string")
    def maps(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = transducer(path)
        for texts in batches:
            machine.trim()
            yield pd.DataFrame([machine.chunk_map(t.replace(" ", "▁")) for t in texts], columns=["head", "cut", "tokens", "tail"])

    def composed(group: pd.DataFrame) -> pd.DataFrame:
        machine, whole = transducer(path), ("", False, 0, "")
        machine.trim()
        for row in group.sort_values("rn").itertuples():
            whole = machine.compose(whole, (row.head, row.cut, row.tokens, row.tail))
        return pd.DataFrame([[group["key"].iloc[0], group["run"].iloc[0], *whole]], columns=["key", "rn", "head", "cut", "tokens", "tail"])

    @F.pandas_udf("long")
    def total(head: pd.Series, cut: pd.Series, tokens: pd.Series, tail: pd.Series) -> pd.Series:
        machine, counts = transducer(path), []
        for whole in zip(head, cut, tokens, tail, strict=True):
            machine.trim()
            counts.append(machine.total(machine.compose(("▁", False, 0, "▁"), whole)) if whole[0] else 0)
        return pd.Series(counts, dtype="int64")

    rows = chunks.select(F.col(quoted(key)).alias("key"), F.col(quoted(order)).alias("at"), maps(F.coalesce(F.col(quoted(text_col)), F.lit(""))).alias("m")).select("key", "at", "m.*")
    rows = numbered(rows, "key", "at").select("key", "rn", "head", "cut", "tokens", "tail")
    kind = chunks.schema[key].dataType.simpleString()
    left = rows.count()
    while left > 0:
        runs = rows.withColumn("run", F.floor(F.col("rn") / FOLD))
        rows = stored(runs.groupBy("key", "run").applyInPandas(composed, f"key {kind}, rn long, head string, cut boolean, tokens long, tail string"), "maps")
        left //= FOLD
    return rows.select(F.col("key").alias(key), total("head", "cut", "tokens", "tail").alias("n_tokens"))
