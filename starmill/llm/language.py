"""Language of a text, word first: known words by their frequency, unseen ones by ever shorter character n-grams.

A word that some language knows is worth the negative logarithm of its share of
that language's words, and a fixed penalty in the languages that don't know it.
An unseen word is worth the mean over its longest n-grams of which any language
knows one; if there are none, the n-grams that are one shorter are asked, down
to single characters. A text belongs to the language with the smallest mean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import map_arrow, written

#: What a text is called that has no letter.
UNDETERMINED = "und"
_OTHER = r"[^\p{L}\p{M}]+"


@dataclass(frozen=True)
class WordFirst:
    """``words`` and ``grams`` bound the model that is sent to the executors, in (entry, language) pairs.

    All words and n-grams of the training texts are counted. The model keeps
    those with the largest shares of their language, in whole steps of an
    eighth of an octave, as many as fit; the others are unseen to it.
    """

    longest: int = 5
    words: int = 200_000
    grams: int = 200_000
    #: Cost of a word or n-gram in a language that doesn't know it: a share of e^-15 and less.
    penalty: float = 15.0
    #: Rows with crc32(id as text) mod ``folds`` equal to ``held_out`` are never learnt from.
    folds: int = 3
    held_out: int = 1
    #: Unseen words whose costs a worker remembers.
    remembered: int = 100_000


@dataclass
class LanguageModel:
    """Costs by entry and language. An entry of ``rows`` is a word, or an n-gram with a zero character before it."""

    languages: list[str]
    rows: dict[str, int] = field(default_factory=dict)
    costs: np.ndarray = field(default_factory=lambda: np.empty((0, 0), np.float32))


def held_out(doc_id: Column, how: WordFirst) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % how.folds == how.held_out, F.lit(False))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased runs of letters and marks, one after the other, and the text that each is from; a null text has none."""
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string())), _OTHER)
    words, owners = pc.list_flatten(lists), pc.list_parent_indices(lists)
    # a run of marks alone is no word
    kept = pc.match_substring_regex(words, r"\p{L}")
    return words.filter(kept), owners.filter(kept).to_numpy(zero_copy_only=False)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words by language, counted within each batch."""
    for batch in batches:
        words, owners = split_words(batch.column("text"))
        if not len(words):
            continue
        coded, langs = words.dictionary_encode(), batch.column("lang").dictionary_encode()
        pair = langs.indices.to_numpy()[owners].astype(np.int64) * len(coded.dictionary) + coded.indices.to_numpy()
        pair, n = np.unique(pair, return_counts=True)
        lang, word = np.divmod(pair, len(coded.dictionary))
        columns = [langs.dictionary.take(pa.array(lang)), coded.dictionary.take(pa.array(word)).cast(pa.string()), pa.array(n, pa.int64())]
        yield pa.record_batch(columns, names=["lang", "token", "n"])


def grams_of(word: str, n: int) -> list[str]:
    """All n-grams of a word with a blank on either side."""
    padded = f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def _count_grams(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by_lang: dict[str, dict[str, int]] = {}
        for lang, word, n in zip(*[batch.column(c).to_pylist() for c in ("lang", "token", "n")], strict=True):
            counted = by_lang.setdefault(lang, {})
            for size in range(1, longest + 1):
                for gram in grams_of(word, size):
                    counted[gram] = counted.get(gram, 0) + n
        for lang, counted in by_lang.items():
            counted.pop(" ", None)
            columns = [pa.array([lang] * len(counted), pa.string()), pa.array(list(counted), pa.string()), pa.array(list(counted.values()), pa.int64())]
            yield pa.record_batch(columns, names=["lang", "token", "n"])


_COUNTS = "lang string, token string, n long"


def _largest(counts: DataFrame, of: list[str], most: int) -> list:
    """Rows (token, cost, lang) of the largest shares within groups ``of``, at most ``most`` of them, ties in or out together."""
    totals = F.broadcast(counts.groupBy(*of).agg(F.sum("n").alias("total")))  # a row per language and length
    cost = -F.log(F.col("n") / F.col("total"))
    valued = counts.join(totals, of).select("token", cost.alias("cost"), "lang", F.floor(cost * 8 / np.log(2)).alias("step"))
    # a step for each eighth of an octave: a few hundred rows at most
    steps = sorted((r["step"], r["count"]) for r in valued.groupBy("step").count().collect())
    fitting = [s for (s, _), n in zip(steps, np.cumsum([c for _, c in steps]), strict=True) if n <= most]
    if not fitting:
        return []
    return valued.where(F.col("step") <= fitting[-1]).select("token", "cost", "lang").collect()


def learn(docs: DataFrame, how: WordFirst | None = None) -> LanguageModel:
    """Counts the words and n-grams of all rows of ``docs`` (doc_id, text, lang) that have a language and aren't held out.

    Rows with a null id, text or language are not learnt from; repeated rows
    count each time. Without any row the model knows no language.
    """
    how = how or WordFirst()
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"), how))
    rows = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    words = written(map_arrow(rows, _count_words, _COUNTS).groupBy("lang", "token").agg(F.sum("n").alias("n")), "word-counts")
    grams = map_arrow(words, lambda batches: _count_grams(batches, how.longest), _COUNTS)
    grams = written(grams.groupBy("lang", "token").agg(F.sum("n").alias("n")).withColumn("size", F.length("token")), "gram-counts")
    found = [(token, cost, lang) for token, cost, lang in _largest(words, ["lang"], how.words)]
    found += [("\0" + token, cost, lang) for token, cost, lang in _largest(grams, ["lang", "size"], how.grams)]
    languages = sorted({lang for _, _, lang in found})
    place = {lang: i for i, lang in enumerate(languages)}
    model = LanguageModel(languages)
    for token, _, _ in found:
        model.rows.setdefault(token, len(model.rows))
    model.costs = np.full((len(model.rows), len(languages)), how.penalty, np.float32)
    for token, cost, lang in found:
        model.costs[model.rows[token], place[lang]] = min(cost, how.penalty)
    return model


class _Costs:
    """Costs of words by number: the model's rows first, then unseen words as they come, forgotten together at ``remembered``."""

    def __init__(self, model: LanguageModel, how: WordFirst):
        self.model, self.how = model, how
        self.known = len(model.rows)
        self.forget()

    def forget(self) -> None:
        self.unseen: dict[str, int] = {}
        self.costs = [self.model.costs]

    def longest_grams(self, word: str) -> list[int]:
        """Rows of the longest n-grams of a word of which one at least is known."""
        get = self.model.rows.get
        for size in range(min(self.how.longest, len(word) + 2), 0, -1):
            at = [i for i in map(get, ["\0" + g for g in grams_of(word, size)]) if i is not None]
            if at:
                return at
        return []

    def unseen_costs(self, words: list[str]) -> np.ndarray:
        """Costs of words by their n-grams, one after the other; nothing known of a word is the penalty everywhere."""
        found = [self.longest_grams(word) for word in words]
        sizes = np.array([len(f) for f in found])
        out = np.full((len(words), len(self.model.languages)), self.how.penalty, np.float32)
        some = sizes > 0
        if some.any():
            starts = np.cumsum(sizes[some]) - sizes[some]
            out[some] = np.add.reduceat(self.model.costs[np.array([i for f in found for i in f])], starts) / sizes[some][:, None]
        return out

    def numbers(self, words: list[str]) -> np.ndarray:
        """Numbers of words that are all different."""
        if len(self.unseen) > self.how.remembered:
            self.forget()
        out, more = np.empty(len(words), np.int64), []
        get, unseen, after = self.model.rows.get, self.unseen, self.known + len(self.unseen)
        for i, word in enumerate(words):
            at = get(word)
            if at is None:
                at = unseen.get(word)
                if at is None:
                    at = unseen[word] = after + len(more)
                    more.append(word)
            out[i] = at
        if more:
            self.costs.append(self.unseen_costs(more))
        return out

    def of(self, at: np.ndarray) -> np.ndarray:
        if len(self.costs) == 1:
            return self.costs[0][at]
        self.costs = [self.costs[0], np.concatenate(self.costs[1:])]
        known = at < self.known
        out = np.empty((len(at), len(self.model.languages)), np.float32)
        out[known], out[~known] = self.costs[0][at[known]], self.costs[1][at[~known] - self.known]
        return out


def predict_language(docs: DataFrame, model: LanguageModel, how: WordFirst | None = None) -> DataFrame:
    """doc_id, lang_pred, score, n_words, n_known for each row of ``docs`` (doc_id, text); other columns are left out.

    ``score`` is the share of the best language in the sum of e^-cost over all
    languages, 0 to 1; of equal ones the first by name is taken. A text that is
    null, empty or without a letter is ``und`` with score 0, as is every text
    where the model knows no language. ``n_known`` counts words that the model
    knows as words. Repeated rows have equal results.
    """
    how = how or WordFirst()
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by how.words and how.grams

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        costs = _Costs(model, how)
        for batch in batches:
            words, owners = split_words(batch.column("text"))
            total = np.bincount(owners, minlength=batch.num_rows).astype(np.int64)
            known, names, scores = np.zeros(batch.num_rows, np.int64), [UNDETERMINED] * batch.num_rows, np.zeros(batch.num_rows)
            if len(words) and model.languages:
                coded = words.dictionary_encode()
                at = costs.numbers(coded.dictionary.to_pylist())
                value, each = costs.of(at), coded.indices.to_numpy()
                known = np.bincount(owners, at[each] < costs.known, batch.num_rows).astype(np.int64)
                ends = np.cumsum(total)
                for i in np.flatnonzero(total):
                    # a text's different words, so that a long one takes no more than its vocabulary
                    distinct, n = np.unique(each[ends[i] - total[i] : ends[i]], return_counts=True)
                    mean = n.astype(float) @ value[distinct].astype(float) / total[i]
                    best = int(mean.argmin())
                    names[i], scores[i] = model.languages[best], 1 / np.exp(np.minimum(mean[best] - mean, 0)).sum()
            columns = [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores), pa.array(total), pa.array(known)]
            yield pa.record_batch(columns, names=["doc_id", "lang_pred", "score", "n_words", "n_known"])

    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(thin, predict, "doc_id long, lang_pred string, score double, n_words long, n_known long")


def language_report(docs: DataFrame, how: WordFirst | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): what ``predict_language`` gives, and ``held_out``; a null id isn't held out."""
    how = how or WordFirst()
    return predict_language(docs, learn(docs, how), how).withColumn("held_out", held_out(F.col("doc_id"), how))
