"""Language identification of mixed texts.

A word's script (by Unicode ranges) narrows the languages it can be in to those that training
texts write in that script. Within a script words are scored by character trigrams per language,
and Viterbi over a text's words, with a penalty for each switch, labels its spans. The text's
language is the one with most letters; the score is that language's share of the letters.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetfold.llm.common import store

#: Documents the model is learned from, at most (by digest of the id, over the whole table).
SAMPLE = 20_000
#: Log-odds that a change of language between two words costs.
SWITCH = 6.0
#: Trigram cells per language, and the weight of an unseen one.
CELLS, SMOOTH = 1 << 16, 0.5
#: Code points of text handled at once.
CHUNK = 1 << 19
UNKNOWN = "und"

#: First code points of script ranges; a range lasts to the next one.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "other"), (0x0E00, "Thai"),
    (0x0E80, "other"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "other"), (0x1E00, "Latin"),
    (0x1F00, "Greek"), (0x2000, "other"), (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"), (0x3190, "Han"),
    (0xA4D0, "other"), (0xAC00, "Hangul"), (0xD7B0, "other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"),
    (0xFB50, "Arabic"), (0xFE70, "Arabic"), (0xFF00, "other"), (0x20000, "Han"), (0x323B0, "other"),
)
_STARTS = np.array([s for s, _ in SCRIPTS])
SCRIPT_NAMES = sorted({n for _, n in SCRIPTS})
_SCRIPT = np.array([SCRIPT_NAMES.index(n) for _, n in SCRIPTS], np.int64)


@lru_cache(maxsize=None)
def _letters() -> np.ndarray:
    """Lower-case code point of each letter, 0 for every other character."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


class Letters:
    """The words (runs of letters) of many texts: their lower-case letters, trigram cells and scripts."""

    def __init__(self, texts: list[str]):
        joined = "\n".join(texts) + "\n"
        low = _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
        is_letter = low > 0
        edge = np.flatnonzero(np.diff(is_letter.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
        self.start, self.end = edge[0::2], edge[1::2]
        at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        self.first = np.searchsorted(self.start, at)  # first[d] .. first[d + 1]: words of text d
        self.base = at
        self.size = self.end - self.start
        # the trigram around each letter; a word is framed by zeros
        pad = np.concatenate([[0], low, [0]]).astype(np.uint64)
        self.where = np.flatnonzero(is_letter)
        p = self.where
        gram = (pad[p] * np.uint64(0x9E3779B97F4A7C15) ^ pad[p + 1] * np.uint64(0xC2B2AE3D27D4EB4F)) + pad[p + 2] * np.uint64(0x165667B19E3779F9)
        gram ^= gram >> np.uint64(29)
        self.cell = ((gram * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)).astype(np.int64)
        self.script = _SCRIPT[np.searchsorted(_STARTS, low[self.start], side="right") - 1] if len(self.start) else np.zeros(0, np.int64)
        self.letter_first = np.concatenate([[0], np.cumsum(self.size)])  # the letters of word i


class Model:
    """Trigram log-probabilities per language, and which languages a script can hold."""

    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.languages = languages
        total = counts.sum(axis=1, keepdims=True)
        self.log = np.log((counts + SMOOTH) / (total + SMOOTH * CELLS)).astype(np.float32).T.copy()  # cells x languages
        # a language stays a candidate for a script that holds a hundredth of its words or more;
        # a script that none was seen in leaves all of them
        share = scripts / np.maximum(1, scripts.sum(axis=1, keepdims=True))
        allowed = (share >= 0.01).T
        allowed[~allowed.any(axis=1)] = True
        self.barred = np.where(allowed, 0.0, -1e6).astype(np.float32)  # scripts x languages

    def word_scores(self, t: Letters) -> np.ndarray:
        """Log-likelihood of each word in each language (words x languages)."""
        if not len(t.start):
            return np.zeros((0, len(self.languages)), np.float32)
        out = np.empty((len(t.start), len(self.languages)), np.float32)
        for j in range(len(self.languages)):
            out[:, j] = np.add.reduceat(self.log[t.cell, j], t.letter_first[:-1])
        return out + self.barred[t.script]


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of every word of many texts (text d: words first[d] .. first[d + 1]), where
    a change between neighbours costs ``switch``. Texts go forward together, one word a step."""
    n, k = scores.shape
    begin, length = first[:-1], np.diff(first)
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    steps = int(length[0]) if len(length) else 0
    running = np.searchsorted(-length, -np.arange(steps), side="left")  # texts longer than step s
    best = np.zeros((len(order), k), np.float32)
    came = np.zeros((n, k), np.uint8 if k < 256 else np.uint16)  # the language before, per word and language
    own = np.arange(k)
    for s in range(steps):
        m = int(running[s])
        at = begin[:m] + s
        if s:
            b = best[:m]
            top = b.argmax(axis=1)
            jump = b[np.arange(m), top][:, None] - switch
            stay = b >= jump
            came[at] = np.where(stay, own, top[:, None])
            best[:m] = np.where(stay, b, jump) + scores[at]
        else:
            best[:m] = scores[at]
        best[:m] -= best[:m].max(axis=1, keepdims=True)
    path = np.zeros(n, np.int64)
    now = best.argmax(axis=1)
    for s in range(steps - 1, -1, -1):
        m = int(running[s])
        at = begin[:m] + s
        path[at] = now[:m]
        now[:m] = came[at, now[:m]] if s else now[:m]
    return path


def _chunks(texts: list[str | None]):
    run, size, begin = [], 0, 0
    for i, t in enumerate(texts):
        run.append(t or "")
        size += len(run[-1])
        if size >= CHUNK:
            yield begin, run
            run, size, begin = [], 0, i + 1
    if run:
        yield begin, run


def _count_cells(batches):
    """Trigram and script counts of a task's texts by language, one row per language."""
    grams: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for begin, some in _chunks(batch.column("text").to_pylist()):
            t = Letters(some)
            for d in range(len(some)):
                a, b = int(t.first[d]), int(t.first[d + 1])
                lang = langs[begin + d]
                if lang not in grams:
                    grams[lang], scripts[lang] = np.zeros(CELLS, np.int64), np.zeros(len(SCRIPT_NAMES), np.int64)
                grams[lang] += np.bincount(t.cell[t.letter_first[a]:t.letter_first[b]], minlength=CELLS)
                scripts[lang] += np.bincount(t.script[a:b], minlength=len(SCRIPT_NAMES))
    if grams:
        yield pa.RecordBatch.from_arrays([pa.array(list(grams)), pa.array([g.tobytes() for g in grams.values()], pa.binary()),
                                          pa.array([s.tobytes() for s in scripts.values()], pa.binary())], names=["lang", "grams", "scripts"])


def train(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from ``doc_id, text, lang`` rows without nulls in text or lang: from all of them, or
    from about ``sample`` whole texts chosen by digest of id and text, if there are more. What comes
    to the driver is one table of counts per language and task of that bounded sample, which is read
    in a bounded number of tasks; a language's counts have a fixed size."""
    rows = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    total = rows.count()
    if total > sample:
        # chosen where the table is read, written, and only then dealt to few tasks
        rows = store(rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int((1 << 30) * sample / total)), "lang-sample")
    parts = rows.coalesce(16).mapInArrow(_count_cells, "lang string, grams binary, scripts binary").toLocalIterator()
    grams: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}
    for p in parts:
        grams[p.lang] = grams.get(p.lang, 0) + np.frombuffer(p.grams, np.int64)
        scripts[p.lang] = scripts.get(p.lang, 0) + np.frombuffer(p.scripts, np.int64)
    languages = sorted(grams)
    if not languages:
        return Model([UNKNOWN], np.zeros((1, CELLS)), np.zeros((1, len(SCRIPT_NAMES))))
    return Model(languages, np.array([grams[x] for x in languages]), np.array([scripts[x] for x in languages]))


SPANS = "array<struct<start:long,end:long,lang:string>>"


def _label(model, with_spans: bool):
    def run(batches):
        m: Model = model.value
        k = len(m.languages)
        for batch in batches:
            lang, score, spans = [], [], []
            for _, some in _chunks(batch.column("text").to_pylist()):
                t = Letters(some)
                path = viterbi(m.word_scores(t), t.first)
                text_of = np.repeat(np.arange(len(some)), np.diff(t.first))
                weight = np.bincount(text_of * k + path, weights=t.size, minlength=len(some) * k).reshape(-1, k)
                total, best = weight.sum(axis=1), weight.argmax(axis=1)
                lang += [m.languages[j] if w else UNKNOWN for j, w in zip(best.tolist(), total.tolist())]
                score += (weight.max(axis=1) / np.maximum(total, 1)).tolist()
                if with_spans:
                    for d in range(len(some)):
                        a, b = int(t.first[d]), int(t.first[d + 1])
                        cuts = [a, *(a + 1 + np.flatnonzero(np.diff(path[a:b]))).tolist(), b] if b > a else []
                        spans.append([{"start": int(t.start[i] - t.base[d]), "end": int(t.end[j - 1] - t.base[d]), "lang": m.languages[path[i]]}
                                      for i, j in zip(cuts, cuts[1:])])
            arrays = [*(batch.column(c) for c in batch.schema.names if c != "text"), pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            names = [*(c for c in batch.schema.names if c != "text"), "lang_pred", "score"]
            if with_spans:
                kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])
                arrays.append(pa.array(spans, pa.list_(kind)))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    return run


def identify(texts: DataFrame, model: Model, spans: bool = False) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``texts`` (``doc_id``, ``text``), and with
    ``spans`` the labelled spans in code points. A null text, an empty one and one without a
    letter are ``und`` with score 0 (and no span). Nothing but the text enters a prediction."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, lang_pred string, score double" + (f", spans {SPANS}" if spans else "")
    return texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_label(shared, spans), schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: the CRC-32 of its id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1, F.lit(False))
