"""Language ID by a linear-chain conditional random field over the words of a text, each word labelled by forward-backward.

Labelled texts have one language each, so half of the training sequences are made of the halves of two of them: the field
learns from these what a switch of language looks like, and how rare it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import each_slice, lowered, span_hashes, word_spans

UNDETERMINED = "und"
#: Labelled rows that the model is fitted on, at most, shared out evenly over the languages, and characters of each: of a
#: longer text a window at a place chosen by its hash. So the fit has at most SAMPLE_ROWS * SAMPLE_CHARS characters.
SAMPLE_ROWS, SAMPLE_CHARS = 600, 20_000
#: log2 of the feature table, words of a training sequence, steps and step size of the fit, weight of the penalty.
BITS, SEQUENCE, STEPS, RATE, PENALTY = 17, 48, 40, 0.15, 1e-4
#: A word is in a language's lexicon if it stands in the sample this often, with this share of its uses there.
LEXICON_USES, LEXICON_SHARE = 4, 0.8
SLICE = 1 << 20


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # features x labels
    lexicon: np.ndarray  # weights of a word's lexicon: (labels + 1) x labels
    transitions: np.ndarray  # from x to, logarithms
    words: np.ndarray  # hashes of the lexicons' words, ascending
    word_label: np.ndarray


def features(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers of each word end to end, where each word's begin): n-grams of 1 to 3 bytes of the word between
    marks, so that those at its edges are affixes, and its first and its last four bytes."""
    lens = ends - starts + 2
    heads = np.cumsum(lens) - lens
    total = int(lens.sum())
    b = np.full(total, 2, np.uint64)
    inner = np.ones(total, bool)
    inner[heads] = False
    inner[heads + lens - 1] = False
    b[heads + lens - 1] = 3
    raw = ends - starts
    b[inner] = buf[np.repeat(starts - (np.cumsum(raw) - raw), raw) + np.arange(int(raw.sum()))]
    word = np.repeat(np.arange(len(starts)), lens)
    at = np.arange(total)
    left = heads[word] + lens[word] - at  # bytes from here to the end of the word
    pad = np.concatenate([b, np.zeros(3, np.uint64)])
    code, out_word, out = b.copy(), [word], [b]
    for n in (2, 3):
        code = code * np.uint64(256) + pad[n - 1 : n - 1 + total]
        ok = left >= n
        out.append(code[ok] + np.uint64(n << 40))
        out_word.append(word[ok])
    four = np.minimum(lens, 5)
    for kind, first in ((4, heads), (5, heads + lens - four)):
        v = np.zeros(len(starts), np.uint64)
        for j in range(5):
            v = np.where(j < four, v * np.uint64(256) + b[np.minimum(first + j, total - 1)], v)
        out.append(v + np.uint64(kind << 44))
        out_word.append(np.arange(len(starts)))
    f = np.concatenate(out) * np.uint64(0x9E3779B97F4A7C15)
    w = np.concatenate(out_word)
    order = np.argsort(w, kind="stable")
    f = (f[order] >> np.uint64(64 - BITS)).astype(np.int64)
    return f, np.searchsorted(w[order], np.arange(len(starts)))


def _word_scores(weights: np.ndarray, f: np.ndarray, heads: np.ndarray, portion: int = 1 << 14) -> np.ndarray:
    """Sums of the weights of each word's features over the root of their number, a portion of words at a time."""
    ends = np.append(heads, len(f))
    out = np.empty((len(heads), weights.shape[1]))
    for a in range(0, len(heads), portion):
        b = min(a + portion, len(heads))
        rows = weights[f[ends[a] : ends[b]]]
        out[a:b] = np.add.reduceat(rows, heads[a:b] - ends[a], axis=0) / np.sqrt(np.diff(ends[a : b + 1]))[:, None]
    return out


def forward_backward(scores: np.ndarray, before: np.ndarray, transitions: np.ndarray, pairs: bool = False):
    """Marginals of the labels of each word, for sequences end to end (before: words before each), all sequences at once.

    Also the expected transitions if pairs is set. Sequences are taken longest first, so step t touches those that have
    a t-th word."""
    lens = np.diff(before)
    order = np.argsort(-lens, kind="stable")
    lens, first = lens[order], before[:-1][order]
    k = scores.shape[1]
    local = np.exp(scores - scores.max(1, keepdims=True))
    a = np.exp(transitions - transitions.max())
    alpha, beta = np.empty_like(local), np.ones_like(local)
    longest = int(lens[0]) if len(lens) else 0
    active = np.searchsorted(-lens, -np.arange(longest), "left")  # sequences longer than t
    prev = None
    for t in range(longest):
        at = first[: active[t]] + t
        x = local[at] if t == 0 else (prev[: active[t]] @ a) * local[at]
        x /= x.sum(1, keepdims=True)
        alpha[at] = prev = x
    expected = np.zeros((k, k))
    for t in range(longest - 2, -1, -1):
        at = first[: active[t + 1]] + t
        right = local[at + 1] * beta[at + 1]
        x = right @ a.T
        if pairs:
            joint = alpha[at][:, :, None] * a[None] * right[:, None, :]
            expected += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        beta[at] = x / x.sum(1, keepdims=True)
    gamma = alpha * beta
    gamma /= gamma.sum(1, keepdims=True)
    return (gamma, expected) if pairs else gamma


def _distinct(buf: np.ndarray, s: np.ndarray, e: np.ndarray):
    h = span_hashes(buf, s, e)
    return np.unique(h, return_index=True, return_inverse=True)


def _lexicon_of(model_words: np.ndarray, labels: np.ndarray, h: np.ndarray, none: int) -> np.ndarray:
    if not len(model_words):
        return np.full(len(h), none)
    k = np.minimum(np.searchsorted(model_words, h), len(model_words) - 1)
    return np.where(model_words[k] == h, labels[k], none)


def switched(cuts: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(places of words, cuts) of as many sequences of the same words: half of them as they are, and of the others, two by
    two, the first half of one followed by the second half of the other."""
    order = np.random.default_rng(seed).permutation(len(cuts) - 1)
    a, b, half = cuts[:-1], cuts[1:], (cuts[:-1] + cuts[1:] + 1) // 2
    whole = len(order) - len(order) // 4 * 2
    parts = [[(a[i], b[i])] for i in order[:whole]]
    for p, q in zip(order[whole::2], order[whole + 1 :: 2]):
        parts += [[(a[p], half[p]), (half[q], b[q])], [(a[q], half[q]), (half[p], b[p])]]
    take = np.concatenate([np.arange(x, z) for part in parts for x, z in part]) if parts else np.zeros(0, np.int64)
    lens = np.array([sum(z - x for x, z in part) for part in parts], np.int64)
    return take, np.concatenate([[0], np.cumsum(lens[lens > 0])]).astype(np.int64)


def fit(rows: list[tuple[str, str]]) -> Model:
    """Fits the field to (text, language) rows by gradient steps on the likelihood, in runs of SEQUENCE words.

    Every word of a text is taken to be in the text's language; switched() makes runs with two. Without rows the model
    has no label."""
    labels = sorted({lang for _, lang in rows})
    k = len(labels)
    texts = [t.encode() for t, _ in rows]
    buf = lowered(np.frombuffer(b"".join(texts), np.uint8))
    s, e, before = word_spans(buf, np.cumsum([0, *map(len, texts)]))
    if not k or not len(s):
        return Model(labels, np.zeros((1 << BITS, max(k, 1)), np.float32), np.zeros((k + 1, max(k, 1))), np.zeros((max(k, 1),) * 2), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    y = np.repeat(np.searchsorted(labels, [lang for _, lang in rows]), np.diff(before))
    h, where, which = _distinct(buf, s, e)
    uses = np.zeros((len(h), k))
    np.add.at(uses, (which, y), 1)
    # A text's own words must not all be known from the lexicon when it is fitted: half of the runs do without it.
    known = (uses.sum(1) >= LEXICON_USES) & (uses.max(1) >= LEXICON_SHARE * uses.sum(1))
    lex_words, lex_label = h[known], uses[known].argmax(1)
    lex = np.where(known, uses.argmax(1), k)
    f, heads = features(buf, s[where], e[where])
    n_features = np.diff(np.append(heads, len(f)))
    word_of_feature = np.repeat(np.arange(len(h)), n_features)
    cuts = np.unique(np.concatenate([before, *[np.arange(a, b, SEQUENCE) for a, b in zip(before[:-1], before[1:])]])).astype(np.int64)
    take, cuts = switched(cuts)
    which, y = which[take], y[take]
    plain = np.repeat(np.arange(len(cuts) - 1) % 2 == 0, np.diff(cuts))
    lex_of = np.where(plain, k, lex[which])
    onehot = np.eye(k)[y]
    inside = np.ones(len(y), bool)
    inside[cuts[:-1]] = False
    seen = np.zeros((k, k))
    np.add.at(seen, (y[np.flatnonzero(inside) - 1], y[inside]), 1)
    params = [np.zeros((1 << BITS, k)), np.zeros((k + 1, k)), np.zeros((k, k))]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        w, lw, tr = params
        scores = _word_scores(w, f, heads)[which] + lw[lex_of]
        gamma, pairs = forward_backward(scores, cuts, tr, pairs=True)
        miss = onehot - gamma
        by_word = np.stack([np.bincount(which, miss[:, j], len(h)) for j in range(k)], 1) / np.sqrt(n_features)[:, None]
        g = [
            np.stack([np.bincount(f, by_word[word_of_feature, j], 1 << BITS) for j in range(k)], 1),
            np.stack([np.bincount(lex_of, miss[:, j], k + 1) for j in range(k)], 1),
            seen - pairs,
        ]
        for i, p in enumerate(params):
            grad = g[i] / len(y) - PENALTY * p
            m[i] = 0.9 * m[i] + 0.1 * grad
            v[i] = 0.99 * v[i] + 0.01 * grad**2
            p += RATE * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-8)
    return Model(labels, params[0].astype(np.float32), params[1], params[2], lex_words, lex_label)


def has_letter(raw: np.ndarray) -> bool:
    low = raw | 0x20
    if ((low >= 97) & (low <= 122)).any():
        return True
    return bool((raw >= 0x80).any()) and any(c.isalpha() for c in raw.tobytes().decode("utf-8", "replace"))


def label(model: Model, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(marginals of each word, words before each text)."""
    low = lowered(buf)
    s, e, before = word_spans(low, offs)
    if not len(s):
        return np.zeros((0, len(model.labels))), before
    h, where, which = _distinct(low, s, e)
    f, heads = features(low, s[where], e[where])
    scores = _word_scores(model.weights, f, heads) + model.lexicon[_lexicon_of(model.words, model.word_label, h, len(model.labels))]
    return forward_backward(scores[which], before, model.transitions), before


def judged(m: Model, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(label of each text, or the number of labels for none, its score, marginals of each word, words before each text)."""
    n = len(offs) - 1
    best, score = np.full(n, len(m.labels)), np.ones(n)
    gamma, before = label(m, buf, offs) if m.labels else (np.zeros((0, 0)), np.zeros(n + 1, np.int64))
    full = np.flatnonzero(np.diff(before) > 0)
    if len(full):
        mean = np.add.reduceat(gamma, before[full], axis=0) / np.diff(before)[full][:, None]
        best[full], score[full] = mean.argmax(1), np.minimum(mean.max(1), 1.0)
    for i in full.tolist():
        if not has_letter(buf[offs[i] : offs[i + 1]]):
            best[i], score[i] = len(m.labels), 1.0
    return best, score, gamma, before


def sample(labelled: DataFrame, text_column: str, lang_column: str, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """At most `rows` different labelled texts, as many of each language as of any other where there are so many: those of
    least hash of text and label, the same ones at each run. Of a text of more than `chars` characters, a window.

    Only the `rows` most frequent languages can have a text. Rows with a hash above a line that lets about four times as
    many of their language by are left out before anything is sent, so that this does not grow with the number of rows."""
    known = labelled.select(F.col(text_column).cast("string").alias("t"), F.col(lang_column).cast("string").alias("l")).where("t is not null and l is not null")
    known = known.withColumn("h", F.xxhash64("t", "l"))
    langs = known.groupBy("l").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l").limit(rows).collect()
    if not langs:
        return []
    each = rows // len(langs)
    window = F.substr("t", F.lit(1) + F.pmod(F.col("h"), F.greatest(F.lit(1), F.length("t") - F.lit(chars))).cast("int"), F.lit(chars))
    out = []
    for slack in (4, 64, None):  # copies have one hash, so a line may let too few different texts by
        missing = [r for r in langs if r["l"] not in {lang for _, lang in out}]
        if not missing:
            break
        below = F.lit(False)
        for r in missing:
            line = 2**63 - 1 if slack is None or r["n"] <= slack * each else int(-(2**63) + 2**64 * slack * each / r["n"])
            below = below | ((F.col("l") == r["l"]) & (F.col("h") <= F.lit(line)))
        got = known.where(below).groupBy("l", "h").agg(F.min(window).alias("t"))
        got = got.withColumn("k", F.row_number().over(Window.partitionBy("l").orderBy("h"))).where(F.col("k") <= each).collect()
        for r in missing:
            mine = [(x["t"], x["l"]) for x in sorted(got, key=lambda x: x["k"]) if x["l"] == r["l"]]
            if slack is None or r["n"] <= slack * each or len(mine) >= each:
                out += mine
    return sorted(out, key=lambda x: (x[1], x[0]))


def held_out(id_column: str) -> Column:
    """Rows whose crc32 of the id as text leaves 2 when divided by 4; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", words: bool = False) -> DataFrame:
    """(id, lang_pred, score) of each row, and with words the label of each word (word_langs, array).

    lang_pred is the label with the largest mean marginal over the text's words, score is that mean; of equal ones the
    first by name. A text that is null or has no letter is `und` with score 1, and so is every text under a model
    without labels. Rows are independent, repeated ones give a row each; no shuffle. Texts of any length are labelled
    whole, empty tables give no rows, and columns other than the two are not read."""
    spark = docs.sparkSession
    fitted = spark.sparkContext.broadcast(model)
    fields = [T.StructField(id_column, docs.schema[id_column].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    fields += [T.StructField("word_langs", T.ArrayType(T.StringType()))] * words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = fitted.value
        names = np.array([*m.labels, UNDETERMINED], object)
        for rows, buf, offs in each_slice(batches, "text", SLICE):
            best, score, gamma, before = judged(m, buf, offs)
            cols = [rows.column("id"), pa.array(names[best], pa.string()), pa.array(score)]
            if words:
                each = gamma.argmax(1) if len(gamma) else np.zeros(0, np.int64)
                cols.append(pa.array([names[each[a:b]].tolist() for a, b in zip(before[:-1], before[1:])], pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays(cols, [f.name for f in fields])

    return docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, T.StructType(fields))


def keep_identified(docs: DataFrame, model: Model, least: float, text_column: str = "text") -> DataFrame:
    """The rows of docs, all columns as they are, whose text is in one of the model's languages with a score of `least`.

    Null texts and texts without a letter go; repeated rows stay or go together; empty tables give no rows."""
    fitted = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = fitted.value
        for rows, buf, offs in each_slice(batches, text_column, SLICE):
            best, score, _, _ = judged(m, buf, offs)
            yield rows.filter(pa.array((best < len(m.labels)) & (score >= least)))

    return docs.mapInArrow(run, docs.schema)


def fit_and_identify(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", rows: int = SAMPLE_ROWS) -> DataFrame:
    """Learns from the rows that held_out() leaves and labels all rows: (id, held_out, lang_pred, score)."""
    model = fit(sample(docs.where(~held_out(id_column)), text_column, lang_column, rows))
    out = identify(docs, model, id_column, text_column)
    return out.select(id_column, held_out(id_column).alias("held_out"), "lang_pred", "score")
