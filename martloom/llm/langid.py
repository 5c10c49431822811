"""Language identification of spans.

Every word is scored for every language by a letter model (probability of a letter
after two others). The word's script leaves only the languages written in it. A path
through the words with the best sum, less a penalty for each change of language,
labels the spans of a mixed text.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import held_out

#: Documents of each language that the letter model is fitted on, about; chosen by hash.
SAMPLE = 2000
#: Letters with a class of their own; all others share one.
ALPHABET = 62
#: What a change of language costs, in nats.
PENALTY = 12.0
#: A script belongs to a language if this share of its letters is written in it.
SCRIPT_SHARE = 0.01
#: Code points and words that are held at once.
CHARS, WORDS = 1 << 19, 1 << 19
UNKNOWN = "und"

#: First code points of blocks, up to the next, by script.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "latin"),
    (0x2E80, "han"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"),
    (0xFB50, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"), (0x10000, "other"), (0x20000, "han"), (0x32000, "other"),
)
SCRIPT_NAMES = tuple(sorted({name for _, name in SCRIPTS}))


def _is_letter(code: int) -> bool:
    return unicodedata.category(chr(code))[0] == "L"


@dataclass
class Model:
    languages: list[str]
    #: Class of a code point: 0 no letter, 1 any other letter, 2.. the letters of the alphabet, either case.
    classes: np.ndarray
    #: Log probability of the last of three classes, for each language.
    scores: np.ndarray
    #: Script of a code point, as a place in SCRIPT_NAMES.
    scripts: np.ndarray
    #: Which languages a script leaves; all, if none is written in it.
    candidates: np.ndarray

    @property
    def width(self) -> int:
        return ALPHABET + 2


def _trigrams(text: str) -> Counter:
    """Counts of (two before, one before, letter); ' ' stands for anything that is no letter."""
    line = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    return Counter(g for g in map("".join, zip(" " + line, line, line[1:], strict=False)) if g[1:] != "  ")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total.setdefault(lang, Counter()).update(_trigrams(text or ""))
    rows = [(lang, g, n) for lang, c in total.items() for g, n in c.items()]
    if rows:
        langs, grams, counts = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs), pa.array(grams), pa.array(counts, pa.int64())], ["lang", "gram", "n"]
        )


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Letter model from (doc_id, text, lang), lang not null.

    About `sample` documents of each language are read, chosen by a hash of the id; the
    counts of their letter triples, whose number the alphabets bound, come to the driver.
    """
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        raise ValueError("no labelled documents to learn languages from")
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) / 1_000_000
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(sample / n)).otherwise(share)
    chosen = labelled.where(draw < share).select("lang", "text")
    grams = chosen.mapInArrow(_count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return _build(languages, [(r.lang, r.gram, r.n) for r in grams.collect()])


def _build(languages: list[str], grams: list[tuple[str, str, int]]) -> Model:
    place = {lang: k for k, lang in enumerate(languages)}
    letters: Counter = Counter()
    written = np.zeros((len(SCRIPT_NAMES), len(languages)))
    scripts = _script_table()
    for lang, gram, n in grams:
        if gram[2] != " ":
            letters[gram[2]] += n
            written[scripts[ord(gram[2])], place[lang]] += n
    own = {c: k + 2 for k, (c, _) in enumerate(sorted(letters.items(), key=lambda x: (-x[1], x[0]))[:ALPHABET])}
    width = ALPHABET + 2
    classes = np.fromiter((1 if _is_letter(c) else 0 for c in range(0x110000)), np.uint8, 0x110000)
    for c in np.flatnonzero(classes).tolist():
        folded = chr(c).lower()
        classes[c] = own.get(folded if len(folded) == 1 else folded[0], 1)
    counts = np.zeros((width, width, width, len(languages)))
    for lang, gram, n in grams:
        a, b, c = (own.get(x, 1) if x != " " else 0 for x in gram)
        counts[a, b, c, place[lang]] += n
    # each order is smoothed by the one below it
    one = counts.sum(axis=(0, 1)) + 0.5
    one /= one.sum(axis=0)
    two = counts.sum(axis=0)
    two = (two + 20 * one[None]) / (two.sum(axis=1, keepdims=True) + 20)
    three = (counts + 20 * two[None]) / (counts.sum(axis=2, keepdims=True) + 20)
    used = written / np.maximum(written.sum(axis=0), 1) >= SCRIPT_SHARE
    used[~used.any(axis=1)] = True
    scores = np.log(three).reshape(-1, len(languages)).astype(np.float32)
    return Model(languages, classes, scores, scripts, used)


def _script_table() -> np.ndarray:
    starts = np.array([s for s, _ in SCRIPTS])
    names = np.array([SCRIPT_NAMES.index(n) for _, n in SCRIPTS], np.uint8)
    return names[np.searchsorted(starts, np.arange(0x110000), side="right") - 1]


def word_scores(model: Model, texts: list[str]) -> tuple[np.ndarray, ...]:
    """For the words of some texts: text, start, end (code points) and scores of each language."""
    codes = np.frombuffer(" ".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    cls = model.classes[codes].astype(np.int64)
    letter = np.concatenate(([False], cls > 0, [False]))
    turns = np.flatnonzero(letter[1:] != letter[:-1])
    starts, ends = turns[::2], turns[1::2]
    if not len(starts):
        return np.zeros(0, np.int64), starts, ends, np.zeros((0, len(model.languages)), np.float32)
    w = model.width
    padded = np.concatenate(([0, 0], cls, [0]))
    triples = (padded[:-2] * w + padded[1:-1]) * w + padded[2:]
    # a word's letters, and the end after them
    inside = np.zeros(len(triples) + 1, bool)
    inside[:-1] = letter[1:]
    inside[ends] = True
    at = np.flatnonzero(inside)
    lengths = ends - starts + 1
    firsts = np.cumsum(lengths) - lengths
    scores = np.add.reduceat(model.scores[triples[at]], firsts, axis=0)
    script = model.scripts[codes[starts]]
    scores = np.where(model.candidates[script], scores, np.float32(-1e9))
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    owner = np.searchsorted(begins, starts, side="right") - 1
    return owner, starts - begins[owner], ends - begins[owner], scores


def best_path(scores: np.ndarray, counts: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The language of each word. `counts`: words of each text, in the order of `scores`.

    All texts advance together, a word at a time; longer ones are first, so those that
    still run are a prefix. Ties go to staying, then to the first language.
    """
    order = np.argsort(-counts, kind="stable")
    first, length = (np.cumsum(counts) - counts)[order], counts[order]
    labels = np.zeros(len(scores), np.int16)
    if not len(scores):
        return labels
    stay = np.zeros(scores.shape, bool)
    origin = np.zeros(len(scores), np.int16)
    running = np.searchsorted(-length, -np.arange(length[0]), side="left")  # texts with more than t words
    best = scores[first[: running[0]]].astype(np.float64)
    final = np.zeros(len(counts), np.int16)
    for t in range(1, length[0]):
        n = running[t]
        if n < len(best):
            final[n : len(best)] = best[n:].argmax(axis=1)
            best = best[:n]
        rows = first[:n] + t
        top = best.argmax(axis=1)
        switched = best[np.arange(n), top][:, None] - penalty
        stay[rows] = best >= switched
        origin[rows] = top
        best = np.maximum(best, switched) + scores[rows]
    final[: len(best)] = best.argmax(axis=1)
    state = final.copy()
    for t in range(length[0] - 1, -1, -1):
        n = running[t]
        rows = first[:n] + t
        labels[rows] = state[:n]
        if t:
            state[:n] = np.where(stay[rows, state[:n]], state[:n], origin[rows])
    return labels


RESULT = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("spans", T.StringType()),
    ]
)


def _label(model: Model, texts: list[str], penalty: float) -> list[tuple[str, float, str]]:
    """(language of most letters, its share, spans as start:end:language) of each text."""
    results: list[tuple[str, float, str]] = []
    parts, held, words = [], 0, 0

    def finish() -> None:
        owner, start, end, scores = (np.concatenate(x) for x in zip(*parts, strict=True))
        counts = np.bincount(owner, minlength=held)
        labels = best_path(scores, counts, penalty)
        letters = np.zeros((held, len(model.languages)))
        np.add.at(letters, (owner, labels), end - start)
        last = np.cumsum(counts)
        for k in range(held):
            if not counts[k]:
                results.append((UNKNOWN, 0.0, ""))
                continue
            a, b = last[k] - counts[k], last[k]
            cuts = np.concatenate(([a], np.flatnonzero(np.diff(labels[a:b])) + a + 1, [b]))
            spans = ",".join(
                f"{start[x]}:{end[y - 1]}:{model.languages[labels[x]]}" for x, y in zip(cuts, cuts[1:], strict=False)
            )
            top = int(letters[k].argmax())
            results.append((model.languages[top], float(letters[k, top] / letters[k].sum()), spans))

    at = 0
    while at < len(texts):
        size, stop = len(texts[at]), at + 1
        while stop < len(texts) and size + len(texts[stop]) <= CHARS:
            size += len(texts[stop])
            stop += 1
        owner, *rest = word_scores(model, texts[at:stop])
        parts.append((owner + held, *rest))
        held += stop - at
        words += len(owner)
        at = stop
        if words >= WORDS or at == len(texts):
            finish()
            parts, held, words = [], 0, 0
    return results


def language(text: Column, model: Model, penalty: float = PENALTY) -> Column:
    """Struct of lang, score and spans. Null, empty and letterless texts are `und` with score 0."""

    @F.arrow_udf(RESULT)
    def run(texts: pa.Array) -> pa.Array:
        found = _label(model, [t or "" for t in texts.to_pylist()], penalty)
        langs, scores, spans = zip(*found, strict=True) if found else ((), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, pa.string())],
            ["lang", "score", "spans"],
        )

    return run(text)


def fit_or_none(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from the rows that are not held out and have a language; None if there is no such row."""
    rows = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"), 4, 2)).select("doc_id", "text", "lang")
    return fit(rows, sample) if rows.take(1) else None


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, spans (start:end:language in code points, comma-joined).

    lang_pred is the language of most letters, score its share of them. Without a model,
    one is fitted on the rows that are not held out; if there are none, every text is `und`.
    One row for each row of `docs`; repeated rows repeat, null ids stay null, an empty
    table gives no rows. Ties go to the language that comes first. Other columns are not read.
    """
    model = model or fit_or_none(docs)
    if model is None:
        nothing = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit("").alias("spans"))
    found = docs.select(
        "doc_id",
        held_out(F.col("doc_id"), 4, 2).alias("held_out"),
        (nothing if model is None else language(F.col("text"), model)).alias("l"),
    )
    return found.select("doc_id", "held_out", F.col("l.lang").alias("lang_pred"), "l.score", "l.spans")
