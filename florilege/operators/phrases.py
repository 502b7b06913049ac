"""Phrases in texts, word by word.

Phrases make a word-level automaton: states for their beginnings, a transition
for each next word, and for each state the state of its longest proper ending.
A text is read once, whatever the number of phrases; words that no phrase has
lead to the start.  The automaton goes to the tasks as arrays while the phrases
have ``MOST_WORDS`` words at most, which is counted first; beyond that, words
are joined with the phrases' first words instead.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of phrases that an automaton is made of on the driver and sent to the tasks (some 100 bytes each).
MOST_WORDS = 500_000
#: Letters; a slug such as a_b is one word.
WORD = r"[\p{L}_]+"


@dataclass
class Automaton:
    """``step``: state * number of words + word -> state, as two arrays; ``fail`` and ``ends`` by state; ``outputs``: (phrase, length, anchored) of each."""

    words: list[str]
    keys: np.ndarray
    targets: np.ndarray
    fail: np.ndarray
    ends: list[list[tuple[int, int, bool]]]
    link: np.ndarray

    @classmethod
    def of(cls, phrases: list[tuple[int, list[str], bool]]) -> Automaton:
        vocabulary: dict[str, int] = {}
        step: list[dict[int, int]] = [{}]
        ends: list[list[tuple[int, int, bool]]] = [[]]
        for phrase, words, anchored in phrases:
            state = 0
            for w in words:
                word = vocabulary.setdefault(w, len(vocabulary))
                if word not in step[state]:
                    step[state][word] = len(step)
                    step.append({})
                    ends.append([])
                state = step[state][word]
            ends[state].append((phrase, len(words), anchored))
        fail, link = np.zeros(len(step), np.int64), np.zeros(len(step), np.int64)
        todo = deque(step[0].values())
        while todo:
            state = todo.popleft()
            for word, after in step[state].items():
                back = int(fail[state])
                while back and word not in step[back]:
                    back = int(fail[back])
                fail[after] = step[back].get(word, 0)
                link[after] = fail[after] if ends[fail[after]] else link[fail[after]]
                todo.append(after)
        n = max(len(vocabulary), 1)
        flat = sorted((state * n + word, after) for state, by in enumerate(step) for word, after in by.items())
        keys, targets = (np.array([x[k] for x in flat], np.int64) for k in (0, 1))
        return cls(list(vocabulary), keys, targets, fail, ends, link)

    def matcher(self):
        """word numbers -> (place of the last word, phrase, length, anchored) of all places of phrases."""
        n, step = max(len(self.words), 1), dict(zip(self.keys.tolist(), self.targets.tolist(), strict=True))
        fail, ends, link = self.fail.tolist(), self.ends, self.link.tolist()

        def find(numbers: list[int]) -> Iterator[tuple[int, int, int, bool]]:
            state = 0
            for at, word in enumerate(numbers):
                if word < 0:
                    state = 0
                    continue
                after = step.get(state * n + word)
                while after is None and state:
                    state = fail[state]
                    after = step.get(state * n + word)
                state = after or 0
                said = state if ends[state] else link[state]
                while said:
                    for phrase, length, anchored in ends[said]:
                        yield at, phrase, length, anchored
                    said = link[said]

        return find


def _phrases(phrases: DataFrame, token: str) -> DataFrame:
    """phrase_id, p (words), anchored: by the surface where there is one, else by the phrase."""
    said = F.coalesce(F.nullif(F.trim("surface"), F.lit("")), F.col("phrase")) if "surface" in phrases.columns else F.col("phrase")
    anchored = F.coalesce(F.col("anchored"), F.lit(False)) if "anchored" in phrases.columns else F.lit(False)
    own = phrases.select(F.col("phrase_id").cast("long").alias("phrase_id"), F.regexp_extract_all(F.lower(said), F.lit(token), F.lit(0)).alias("p"), anchored.alias("anchored"))
    return own.filter("size(p) > 0")


def phrase_spans(texts: DataFrame, phrases: DataFrame, key: str = "segment_id", text: str = "content", token: str = WORD) -> DataFrame:
    """key, phrase_id, start, length (in words), begin, finish (in signs) of all places of phrases in texts, overlaps too.

    ``phrases``: phrase_id, phrase; ``surface`` (what is looked for in place of
    the phrase) and ``anchored`` (only where nothing but white space stands
    before it) if it has them.  Case doesn't count.  Null and empty texts and
    phrases without words are nowhere; phrases that repeat are found each.
    """
    own = _phrases(phrases, token)
    size = own.agg(F.coalesce(F.sum(F.size("p")), F.lit(0))).first()[0]
    kind = texts.schema[key].dataType.simpleString()
    found = _by_automaton if size <= MOST_WORDS else _by_first_word
    return found(texts.select(key, text).filter(F.col(text).isNotNull()), own, key, kind, token).toDF(key, "phrase_id", "start", "length", "begin", "finish")


_SPAN = "phrase_id long, start int, length int, begin int, finish int"


def _by_automaton(texts: DataFrame, own: DataFrame, key: str, kind: str, token: str) -> DataFrame:
    automaton = Automaton.of([(r["phrase_id"], r["p"], r["anchored"]) for r in own.collect()])  # MOST_WORDS at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, find, pattern = {w: k for k, w in enumerate(automaton.words)}, automaton.matcher(), regex.compile(token)
        for batch in batches:
            rows, out = [], []
            for row, said in enumerate(batch.column(1).to_pylist()):
                low = said.lower()
                placed = [(m.start(), m.end(), words.get(m[0], -1)) for m in pattern.finditer(low)]
                for at, phrase, length, anchored in find([x[2] for x in placed]):
                    start = at - length + 1
                    begin = placed[start][0]
                    if not anchored or not low[:begin].strip():
                        rows.append(row)
                        out.append((phrase, start, length, begin, placed[at][1]))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
            yield pa.record_batch([batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=["key", "phrase_id", "start", "length", "begin", "finish"])

    return texts.mapInArrow(run, f"key {kind}, {_SPAN}")


def _by_first_word(texts: DataFrame, own: DataFrame, key: str, kind: str, token: str) -> DataFrame:
    """Words that begin a phrase, with the words behind them, meet the phrases' words."""
    longest = own.agg(F.max(F.size("p"))).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = regex.compile(token)
        for batch in batches:
            for row, said in enumerate(batch.column(1).to_pylist()):
                low = said.lower()
                placed = [(m[0], m.start(), m.end()) for m in pattern.finditer(low)]
                n = len(placed)
                ahead = [placed[k : k + longest] for k in range(n)]
                yield pa.record_batch(
                    [
                        batch.column(0).slice(row, 1).take(pa.array([0] * n, pa.int64())), pa.array([x[0] for x in placed], pa.string()), pa.array(range(n), pa.int32()), pa.array([x[1] for x in placed], pa.int32()),
                        pa.array([[y[0] for y in x] for x in ahead], pa.list_(pa.string())), pa.array([[y[2] for y in x] for x in ahead], pa.list_(pa.int32())), pa.array([not low[: x[1]].strip() for x in placed], pa.bool_()),
                    ],
                    names=["key", "word", "start", "begin", "ahead", "ends", "opens"],
                )

    placed = texts.mapInArrow(run, f"key {kind}, word string, start int, begin int, ahead array<string>, ends array<int>, opens boolean")
    heads = own.withColumn("word", F.get("p", F.lit(0)))
    same = (F.slice("ahead", F.lit(1), F.size("p")) == F.col("p")) & (F.col("opens") | ~F.col("anchored"))
    return placed.join(heads, "word").filter(same).select("key", "phrase_id", "start", F.size("p").alias("length"), "begin", F.element_at("ends", F.size("p")).alias("finish"))


def masked(texts: DataFrame, spans: DataFrame, key: str = "segment_id", text: str = "content") -> DataFrame:
    """Texts in which spans (key, begin, finish), winners of an overlap or not, became a space; spans that touch or overlap become one."""
    own = spans.groupBy(key).agg(F.array_sort(F.collect_set(F.struct("begin", "finish"))).alias("_s"))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"), F.lit(False).alias("cut"))

    def cut(acc: Column, span: Column) -> Column:
        before = F.substring(F.col(text), acc["at"] + 1, F.greatest(span["begin"] - acc["at"], F.lit(0)))
        fresh = (span["begin"] > acc["at"]) | ~acc["cut"]
        return F.struct(F.when(fresh, F.concat(acc["out"], before, F.lit(" "))).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], span["finish"]).alias("at"), F.lit(True).alias("cut"))

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, F.length(text)))
    joined = texts.join(own, key, "left")
    return joined.withColumn(text, F.when(F.col("_s").isNull(), F.col(text)).otherwise(F.aggregate("_s", start, cut, rest))).drop("_s")
