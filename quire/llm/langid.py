"""Language identification with spans.

A word's script narrows the candidate languages to those that use the script in training; among them the word scores the sum of
log probabilities of its letter trigrams. Viterbi over the words, with a penalty for each switch, labels spans of mixed text.
The language that holds most letters is the prediction and its share of the letters the score.

The trigram model is learned from at most about ``DOCS_PER_LANGUAGE`` labelled texts a language, chosen by a hash of the text;
``fit`` counts all labelled rows to know the share to draw. Everything else covers all rows and whole texts.

Defined cases: a null text or one without letters is ``und`` with score 0; words of a script that no language uses score
nothing, and a text of only such words gets the most frequent language with score 0; ties go to the language that comes first
by code point; null labels are not learned from; without any labelled text everything is ``und``; a row with a null id is not
held out and not learned from; repeated rows get equal rows; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import arrow_map, give_back, remembers, slices

DOCS_PER_LANGUAGE = 1500
SWITCH = 14.0
#: Share of the probability that is spread evenly over all trigrams.
SMOOTHING = 0.02
#: A script belongs to a language that writes at least this share of its letters in it.
SCRIPT_SHARE = 0.01
#: Words that a worker remembers before it starts anew; bounds its memory.
CACHE_ENTRIES = 400_000
WORDS = re.compile(r"[^\W\d_]+")
#: First code points of script ranges; a range ends where the next begins. Fixed values of the Unicode standard's blocks.
SCRIPTS = [
    (0x0000, "common"), (0x0041, "latin"), (0x02B0, "common"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "syriac"), (0x0750, "arabic"), (0x0780, "thaana"), (0x07C0, "common"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"),
    (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1780, "khmer"),
    (0x1800, "mongolian"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "common"), (0x2C80, "coptic"), (0x2E80, "han"),
    (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"), (0x31F0, "kana"), (0x3200, "han"), (0xA000, "yi"),
    (0xA4D0, "common"), (0xAC00, "hangul"), (0xD7B0, "common"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"),
    (0xFB50, "arabic"), (0xFE00, "common"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0x10000, "common"), (0x20000, "han"), (0x30000, "common"),
]
_FROM = [a for a, _ in SCRIPTS]


def script(letter: str) -> str:
    return SCRIPTS[bisect_right(_FROM, ord(letter)) - 1][1]


class Model:
    """Trigram log probabilities and scripts of each language."""

    def __init__(self, counts: dict[str, dict[str, float]], texts: dict[str, int]):
        self.languages = sorted(counts)
        n = len(self.languages)
        self.usual = max(range(n), key=lambda i: (texts.get(self.languages[i], 0), -i)) if n else -1
        grams = sorted(set().union(*counts.values())) if n else []
        self.row = {g: i for i, g in enumerate(grams)}
        self.logs = np.zeros((len(grams) + 1, n))
        self.scripts: dict[str, np.ndarray] = {}
        for j, language in enumerate(self.languages):
            own, letters = counts[language], {}
            total, floor = sum(own.values()), SMOOTHING / (len(grams) + 1)  # alike for languages with much and with little text
            self.logs[:, j] = math.log(floor)
            for g, c in own.items():
                self.logs[self.row[g], j] = math.log((1 - SMOOTHING) * c / total + floor)
                name = script(g[1])
                letters[name] = letters.get(name, 0) + c
            for name, c in letters.items():
                if c >= SCRIPT_SHARE * sum(letters.values()) and name != "common":
                    self.scripts.setdefault(name, np.zeros(n, bool))[j] = True
        self.forget()

    def forget(self) -> None:
        """Row 0 stands for what says nothing."""
        self.known: dict[str, int] = {}
        self.scores, self.letters, self.used = np.zeros((1 << 14, len(self.languages))), np.zeros(1 << 14), 1

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "scores", "letters", "used")}

    def __setstate__(self, state):
        self.__dict__ |= state
        self.forget()

    def score(self, words: list[str]) -> np.ndarray:
        """Log probabilities by language of words of letters, worst possible for languages that the script rules out."""
        get, at, sizes = self.row.get, [], []
        lowered = [w.lower() for w in words]
        for w in lowered:
            padded = f" {w} "
            at.extend([get(padded[i : i + 3], -1) for i in range(len(w))])
            sizes.append(len(w))
        ends = np.cumsum(sizes)
        out = np.add.reduceat(self.logs[at], ends - sizes, axis=0)
        for j, w in enumerate(lowered):
            if w.isascii():
                names = ("latin",)
            else:
                names = {script(c) for c in w if c.isalpha()}
            allowed = [self.scripts[s] for s in names if s in self.scripts]
            if not allowed:
                out[j] = 0.0
            elif not all(map(np.all, allowed)):
                may = np.any(allowed, axis=0)
                out[j] = np.where(may, out[j], out[j][may].min() - 10.0 * len(w))
        return out

    def rows_of(self, words: list[str]) -> list[int]:
        known, new = self.known, []
        for w in set(words).difference(known):
            if w.isalpha():
                new.append((w, w))
            elif letters := "".join(filter(str.isalpha, w)):
                new.append((w, letters))
            else:
                known[w] = 0
        if new:
            more = self.used + len(new)
            if more > len(self.letters):
                self.scores = np.concatenate((self.scores, np.zeros((more, len(self.languages)))))
                self.letters = np.concatenate((self.letters, np.zeros(more)))
            self.scores[self.used : more] = self.score([x for _, x in new])
            self.letters[self.used : more] = [len(x) for _, x in new]
            known.update(zip([w for w, _ in new], range(self.used, more), strict=True))
            self.used = more
        return list(map(known.__getitem__, words))


def viterbi(scores: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """The best label of each row when every change of label costs ``penalty``; ties to the lower label and to staying.

    If no stretch of any other label gains more than half a penalty over the label that is best throughout, no path with a
    change can win, and that label holds everywhere; the recursion runs for the rest."""
    n, k = scores.shape
    totals = scores.sum(0)
    best = int(np.argmax(totals))
    gain = np.cumsum(scores - scores[:, best : best + 1], axis=0)
    low = np.minimum(np.minimum.accumulate(gain, axis=0), 0.0)
    low[1:], low[0] = low[:-1].copy(), 0.0
    if k == 1 or (gain - low).max() <= penalty / 2:
        return np.full(n, best)
    back = np.zeros((n, k), np.int32)
    value = list(scores[0])
    labels = range(k)
    rows = scores.tolist()
    for t in range(1, n):
        top = max(value)
        at, other, row = value.index(top), top - penalty, rows[t]
        back[t] = [j if value[j] >= other else at for j in labels]
        value = [(v if v >= other else other) + s for v, s in zip(value, row, strict=True)]
    out = np.empty(n, np.int64)
    out[-1] = value.index(max(value))
    for t in range(n - 1, 0, -1):
        out[t - 1] = back[t, out[t]]
    return out


def fit(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Learn from the non-null lang and text of ``docs``. The trigram counts of the bounded sample reach the driver."""
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string"), F.col("text").cast("string"))
    texts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not texts:
        return Model({}, {})
    share = F.create_map(*(F.lit(x) for lang, n in texts.items() for x in (lang, min(1.0, docs_per_language / n))))
    sample = labelled.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))
    words = sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), 0)).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    padded = F.concat(F.lit(" "), "word", F.lit(" "))
    grams = words.select("lang", "n", F.explode(F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.substring(padded, i, F.lit(3)))).alias("gram")).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts: dict[str, dict[str, float]] = {}
    for r in grams.collect():
        counts.setdefault(r["lang"], {})[r["gram"]] = r["n"]
    return Model(counts, texts)


def label(model: Model, text: str | None) -> tuple[str, float, list[tuple[str, int, int]]]:
    """Prediction, score and spans (language, first character, one after the last) of one text."""
    found = [m for m in WORDS.finditer(text or "") if any(map(str.isalpha, m[0]))]
    pred, score, labels = _label(model, [m[0] for m in found])
    out: list = []
    for m, j in zip(found, labels, strict=False):  # no labels if there are no languages
        name = model.languages[j]
        if out and out[-1][0] == name:
            out[-1][2] = m.end()
        else:
            out.append([name, m.start(), m.end()])
    return pred, score, [tuple(x) for x in out]


def _label(model: Model, words: list[str]):
    if not words or not model.languages:
        return "und", 0.0, []
    if len(model.known) > CACHE_ENTRIES:
        model.forget()
    rows = model.rows_of(words)
    scores, letters = model.scores[rows], model.letters[rows]
    total = letters.sum()
    if not total:
        return "und", 0.0, []
    if not scores.any():
        return model.languages[model.usual], 0.0, np.full(len(rows), model.usual)
    labels = viterbi(scores)
    share = np.bincount(labels, letters, len(model.languages)) / total
    best = int(np.argmax(share))
    return model.languages[best], float(share[best]), labels


def identify(docs: DataFrame, model: Model, with_spans: bool = True) -> DataFrame:
    """doc_id, lang_pred, score and, if wanted, spans; a map without a shuffle over the text alone."""

    def rows(batches):
        remembers("langid", model.forget)
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            found = [label(model, t) for t in texts] if with_spans else [_label(model, WORDS.findall(t or "")) for t in texts]
            named = [[{"lang": a, "start": b, "stop": c} for a, b, c in x[2]] for x in found] if with_spans else None
            yield [batch.column(0), [x[0] for x in found], [x[1] for x in found], *([named] if with_spans else [])]
        model.forget()  # each task has a model of its own
        give_back()

    schema = "doc_id long, lang_pred string, score double" + (", spans array<struct<lang string, start int, stop int>>" if with_spans else "")
    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), schema, rows)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def op1_langid(spark, sf_dir: str) -> DataFrame:
    """Predicted language of every document; rows whose crc32(doc_id) mod 4 is 2 are not learned from."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    return identify(docs, model, with_spans=False).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def stage(spark, docs: DataFrame, sf_dir: str, least: float = 0.5) -> DataFrame:
    """Documents of which one language holds at least ``least`` of the letters; the rest are rejected."""
    columns = docs.columns
    model = fit(docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    kind = docs.schema

    def rows(batches):
        import pyarrow as pa

        remembers("langid", model.forget)
        for batch in slices(batches):
            found = [_label(model, WORDS.findall(t or "")) for t in batch.column(columns.index("text")).to_pylist()]
            keep = batch.filter(pa.array([x[0] != "und" and x[1] >= least for x in found]))
            yield list(keep.columns)
        model.forget()
        give_back()

    return arrow_map(docs, kind, rows)
