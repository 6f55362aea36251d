"""Review texts: selection and extractive summaries."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.operators.relational import spread_if_small

MIN_WORDS = 8
MAX_WORDS = 100


def word_count(text: Column) -> Column:
    """Whitespace-separated words; surrounding whitespace does not count."""
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))


def worth_summarising(content: DataFrame, min_words: int = MIN_WORDS,
                      col: str = "review_comment_message") -> DataFrame:
    """Reviews whose message is set and has at least ``min_words`` words."""
    return content.filter(F.col(col).isNotNull() & (word_count(F.col(col)) >= min_words))


_SPACE = re.compile(r"[ \t\n\x0b\f\r]+")
_SENTENCE_END = re.compile(r"([.!?])[ \t\n\x0b\f\r]+")


def _words(text: str) -> list[str]:
    return [w for w in _SPACE.split(text) if w]


def summary(text: str, max_words: int = MAX_WORDS, min_summary: int = 10) -> str:
    """The sentences with the densest frequent words of one text, in their order.

    A word of four letters or more weighs its count in the text; a sentence scores its weight
    per word. The best sentences are taken while they fit ``max_words`` and in any case until
    ``min_summary`` words are reached, cut at ``max_words``.
    """
    sentences = _SENTENCE_END.sub("\\1\x01", text.strip(" ")).split("\x01")
    words = [_words(s.lower()) for s in sentences]
    counts = Counter(w for own in words for w in own if len(w) >= 4)
    score = {i: sum(counts[w] for w in own) / len(own) for i, own in enumerate(words) if own}
    taken, total = [], 0
    for i in sorted(score, key=lambda i: (-score[i], i)):
        if total + len(words[i]) > max_words and total >= min_summary:
            break
        taken.append(i)
        total += len(words[i])
    return " ".join(_words(" ".join(sentences[i] for i in sorted(taken)))[:max_words])


def summarise_reviews(content: DataFrame, min_words: int = MIN_WORDS, max_words: int = MAX_WORDS,
                      min_summary: int = 10, key: str = "review_content_key",
                      col: str = "review_comment_message") -> DataFrame:
    """Extractive summaries. All a summary needs is in its row, so nothing is shuffled."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: summary(t, max_words, min_summary))

    chosen = spread_if_small(worth_summarising(content, min_words, col).select(key, col))
    return chosen.select(key, run(F.col(col)).alias("summary"))


def summarise_with(content: DataFrame, load: Callable[[], Callable[[list[str]], list[str]]],
                   key: str = "review_content_key", col: str = "review_comment_message"
                   ) -> DataFrame:
    """Summaries by a user's model; ``load`` runs once per task and gives a batch function."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            yield pd.Series(model(batch.tolist()), dtype=object)

    return worth_summarising(content, col=col).select(key, run(F.col(col)).alias("summary"))
