"""Quality rules as a short-circuit cascade.

A document is kept if it breaks no rule.  On a sample every rule runs on every
document; its cost (time) and its share of rejections are measured, and the
rules are ordered by rejections per cost.  The full pass stops at a document's
first broken rule.  Rules draw on signals computed at most once a document and
only when asked for, so a cheap strict rule spares the dear ones.  The verdict
is a conjunction: it does not depend on the order or on the sample.

Edge cases: a null text has no words and breaks the length rule, as does an
empty or blank one.  Very long texts are judged whole.  Every row is judged by
itself, so repeated rows, ties and null ids need no care.  Only ``doc_id`` and
``text`` are read; an empty table gives no rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import releasing

SAMPLE_ROWS = 400        # documents on which costs and selectivities are measured
SAMPLE_FRACTION = 0.05
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"     # fixed value


class Signals:
    """Lazily computed measures of one text."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode().split()

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACE))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [x for x in self.text.split("\n") if x.strip(SPACE)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        w = self.words
        windows = list(zip(w, w[1:], w[2:]))
        if len(set(windows)) == len(windows):
            return 0
        first: dict = {}
        covered = bytearray(len(w))
        for i, x in enumerate(windows):
            j = first.setdefault(x, i)
            if j != i:
                covered[i:i + 3] = b"\1\1\1"
                covered[j:j + 3] = b"\1\1\1"
        return sum(covered)

    @cached_property
    def n_letters(self) -> int:
        return sum(map(str.isalpha, self.text))

    @property
    def top_word_count(self) -> int:
        count: dict = {}
        for x in self.words:
            count[x] = count.get(x, 0) + 1
        return max(count.values(), default=0)


def base_failed(s: Signals) -> bool:
    return s.n_words < 50 or 100 * s.n_repeat_words > 50 * s.n_words


#: name -> whether the document breaks the rule.  The first two are the base.
RULES: dict[str, Callable[[Signals], bool]] = {
    "too_short": lambda s: s.n_words < 50,
    "repeated_phrases": lambda s: 100 * s.n_repeat_words > 50 * s.n_words,
    "word_length": lambda s: not 2 * s.n_words <= s.word_chars <= 15 * s.n_words,
    "symbols": lambda s: 10 * s.n_symbols > 2 * s.n_words,
    "repeated_lines": lambda s: 10 * s.n_dup_lines > 4 * max(1, len(s.lines)),
    "letters": lambda s: 10 * s.n_letters < 6 * s.word_chars,
}

SIGNALS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
ARROW_SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured_order(docs: DataFrame, rules: tuple[str, ...] = tuple(RULES)) -> tuple[str, ...]:
    """``rules`` by falling rejections per cost on a sample of ``docs``.

    The sample is at most ``SAMPLE_ROWS`` documents; only (cost, broken) pairs
    of them reach the driver.
    """
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b["text"].to_pylist():
                one = []
                for r in rules:
                    s, t = Signals(text), time.perf_counter_ns()
                    broken = RULES[r](s)
                    one.append({"ns": time.perf_counter_ns() - t, "broken": broken})
                rows.append(one)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.struct(
                [("ns", pa.int64()), ("broken", pa.bool_())])))], ["runs"])

    sample = docs.select("text").sample(SAMPLE_FRACTION, seed=7).mapInArrow(
        measure, "runs array<struct<ns:long,broken:boolean>>").take(SAMPLE_ROWS)
    cost, hits = [1] * len(rules), [0] * len(rules)
    for row in sample:
        for i, run in enumerate(row.runs):
            cost[i] += run.ns
            hits[i] += run.broken
    return tuple(sorted(rules, key=lambda r: (-hits[rules.index(r)] / cost[rules.index(r)],
                                              cost[rules.index(r)], r)))


def cascade(signals: Signals, order: tuple[str, ...]) -> str | None:
    """The first rule in ``order`` that the document breaks."""
    return next((r for r in order if RULES[r](signals)), None)


def quality_filter(docs: DataFrame, order: tuple[str, ...] | None = None) -> DataFrame:
    """The rows of ``docs`` that break no rule, with the columns of ``docs``."""
    order = order or measured_order(docs)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([cascade(Signals(t), order) is None for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(releasing(run), docs.schema)


def quality_report(docs: DataFrame, order: tuple[str, ...] | None = None) -> DataFrame:
    """doc_id, the base signals, base_failed and kept of every document."""
    order = order or measured_order(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {c: [] for c in (*ARROW_SIGNALS, "base_failed", "kept")}
            for text in b["text"].to_pylist():
                s = Signals(text)
                for c in ARROW_SIGNALS:
                    out[c].append(getattr(s, c))
                failed = base_failed(s)
                out["base_failed"].append(failed)
                out["kept"].append(not failed and cascade(s, order) is None)
            arrays = [b["doc_id"]] + [pa.array(out[c], pa.int64()) for c in ARROW_SIGNALS]
            yield pa.RecordBatch.from_arrays(
                arrays + [pa.array(out["base_failed"], pa.bool_()), pa.array(out["kept"], pa.bool_())],
                ["doc_id", *ARROW_SIGNALS, "base_failed", "kept"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        releasing(run), f"doc_id long, {SIGNALS}, base_failed boolean, kept boolean")
