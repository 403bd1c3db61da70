"""Language identification by a byte convolutional network.

Filters of several widths over the bytes of fixed-length windows, rectified, max-pooled over the
window, then softmax. The network is trained in numpy on a bounded sample of labelled windows; every
window of every whole text is scored, and a text's probabilities are the letter-weighted mean of its
windows'. A filter over raw bytes is a sum of table rows, so scoring looks up tables of byte pairs.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import first_of_each, with_text_columns

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
# Bounds of the training sample: texts per language, texts in all, windows per text.
PER_LANGUAGE = 600
MAX_TEXTS = 6000
WINDOWS_PER_TEXT = 3

# A-Z as a-z, digits as one, white space and other controls as blanks.
FOLD = bytes(c + 32 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else 32 if c < 32 else c for c in range(256))
IS_LETTER = np.array([97 <= c <= 122 or c >= 128 for c in range(256)])


def windows_of(text: bytes) -> np.ndarray:
    """All windows of a text, the last filled up with blanks."""
    folded = text.translate(FOLD)
    n = max(1, -(-len(folded) // WINDOW))
    return np.frombuffer(folded.ljust(n * WINDOW), np.uint8).reshape(n, WINDOW)


@dataclass
class Network:
    languages: list[str]
    tables: list[np.ndarray]  # per width: (width, 256, filters)
    bias: list[np.ndarray]
    weights: np.ndarray  # (filters of all widths, languages)
    offset: np.ndarray

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest response of every filter in every window, and where it is."""
        best, places = [], []
        for table, bias in zip(self.tables, self.bias):
            n = WINDOW - len(table) + 1
            response = table[0][x[:, :n]]
            for o in range(1, len(table)):
                response += table[o][x[:, o : o + n]]
            at = response.argmax(axis=1)
            best.append(np.take_along_axis(response, at[:, None, :], 1)[:, 0] + bias)
            places.append(at)
        return np.maximum(np.concatenate(best, axis=1), 0), places

    def prepare(self) -> None:
        """Tables of byte pairs: the sum of the first two rows of each width, and of rows 3 and 4."""
        pair = [(t[0][:, None, :] + t[1][None, :, :]).reshape(65536, -1) for t in self.tables]
        self.first = np.ascontiguousarray(np.concatenate(pair, axis=1), np.float32)
        self.third = self.tables[1][2].astype(np.float32)
        self.later = (self.tables[2][2][:, None, :] + self.tables[2][3][None, :, :]).reshape(65536, -1).astype(np.float32)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        f = self.tables[0].shape[2]
        out = np.empty((len(x), 3 * f), np.float32)
        for at in range(0, len(x), 32):
            part = x[at : at + 32]
            code = (part[:, :-1].astype(np.int32) << 8) | part[:, 1:]
            response = self.first.take(code.ravel(), axis=0).reshape(len(part), WINDOW - 1, 3 * f)
            response[:, : WINDOW - 2, f : 2 * f] += self.third[part[:, 2:]]
            response[:, : WINDOW - 3, 2 * f :] += self.later[code[:, 2:]]
            end = out[at : at + 32]
            end[:, :f] = response[:, :, :f].max(axis=1)
            end[:, f : 2 * f] = response[:, : WINDOW - 2, f : 2 * f].max(axis=1)
            end[:, 2 * f :] = response[:, : WINDOW - 3, 2 * f :].max(axis=1)
        hidden = np.maximum(out + np.concatenate(self.bias), 0)
        return softmax(hidden @ self.weights + self.offset)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, languages: list[str], epochs: int = 6, batch: int = 64, seed: int = 7) -> Network:
    """Fit by Adam; max pooling sends a gradient to one place per filter and window."""
    rng = np.random.default_rng(seed)
    net = Network(
        languages,
        [rng.normal(0, 0.3, (w, 256, FILTERS)) for w in WIDTHS],
        [np.zeros(FILTERS) for _ in WIDTHS],
        rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))),
        np.zeros(len(languages)),
    )
    params = [*net.tables, *net.bias, net.weights, net.offset]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    # Languages count alike however many windows they have.
    share = 1 / np.bincount(y, minlength=len(languages)).clip(1)
    share *= len(languages) * len(y) / (share[y].sum() * len(languages))
    step = 0
    for epoch in range(epochs):
        rate = 0.01 / (1 + epoch)
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            rows = order[at : at + batch]
            hidden, places = net.pooled(x[rows])
            delta = softmax(hidden @ net.weights + net.offset)
            delta[np.arange(len(rows)), y[rows]] -= 1
            delta *= share[y[rows]][:, None] / len(rows)
            back = (delta @ net.weights.T) * (hidden > 0)
            grads: list[np.ndarray] = []
            for i, table in enumerate(net.tables):
                own, grad = back[:, i * FILTERS : (i + 1) * FILTERS], np.zeros_like(table)
                for o in range(len(table)):
                    byte = np.take_along_axis(x[rows], places[i] + o, axis=1)
                    np.add.at(grad[o], (byte, np.arange(FILTERS)[None, :]), own)
                grads.append(grad)
            grads += [back[:, i * FILTERS : (i + 1) * FILTERS].sum(axis=0) for i in range(len(WIDTHS))]
            grads += [hidden.T @ delta, delta.sum(axis=0)]
            step += 1
            for p, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def training_windows(
    docs: DataFrame, text: str, lang: str, doc_id: str, learn: Column, per_language: int, max_texts: int
) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows and labels of a bounded sample, taken in the order of a hash of the id.

    Up to ``per_language`` texts of each language, ``max_texts`` in all, the languages' first texts
    first; ``WINDOWS_PER_TEXT`` windows of each text at places that follow from its length.
    """
    labelled = docs.filter(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
    key = F.xxhash64(F.col(doc_id).cast("string"))
    named = labelled.select(F.col(doc_id).alias("i"), F.col(lang).cast("string").alias("lang"), key.alias("h"))
    ranked = first_of_each(named, ["lang"], ["h", "i"], per_language)
    chosen = ranked.orderBy("r", "h", "lang").limit(max_texts).select("i", "lang")
    texts = labelled.select(F.col(doc_id).alias("i"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    sample = texts.join(F.broadcast(chosen.distinct()), ["i", "lang"])

    def make():
        def cut(texts):
            out = []
            for t in texts:
                own = windows_of(t)
                rows = sorted({(2 * i + 1) * len(own) // (2 * WINDOWS_PER_TEXT) for i in range(WINDOWS_PER_TEXT)})
                out.append(own[[r for r in rows if IS_LETTER[own[r]].any()]].tobytes())
            return [pa.array(out, pa.binary())]

        return cut

    rows = with_text_columns(sample, make, "windows binary", "text", keep=["lang", "i"])
    got = rows.select("row.lang", "row.i", "windows").orderBy("i", "lang", "windows").limit(max_texts).collect()
    languages = sorted({r["lang"] for r in got if len(r["windows"])})
    x = [np.frombuffer(bytes(r["windows"]), np.uint8).reshape(-1, WINDOW) for r in got]
    y = [np.full(len(w), languages.index(r["lang"])) for w, r in zip(x, got) if len(w)]
    return np.concatenate(x) if y else np.empty((0, WINDOW), np.uint8), np.concatenate(y) if y else np.empty(0, int), languages


def fit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    learn: Column | None = None,
    per_language: int = PER_LANGUAGE,
    max_texts: int = MAX_TEXTS,
) -> Network | None:
    """A network from the labelled rows where ``learn`` holds; None if there are none."""
    learn = F.lit(True) if learn is None else learn
    x, y, languages = training_windows(docs, text, lang, doc_id, learn, per_language, max_texts)
    return train(x, y, languages) if len(languages) else None


def with_language(docs: DataFrame, network: Network | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the kept columns), ``lang_pred`` and ``score``, without a shuffle.

    ``und`` and 0 if the text is null or has no letter, or nothing was learned. Only the text is
    read. Repeated rows get equal results; an empty table gives none; very long texts are scored
    window by window.
    """

    def make():
        if network is not None:
            network.prepare()

        def score(texts):
            named, scores = ["und"] * len(texts), [0.0] * len(texts)
            if network is None:
                return [named, scores]
            for i, t in enumerate(texts):
                if t is None or not any(map(str.isalpha, t.decode("utf-8", "replace"))):
                    continue
                x = windows_of(t)
                total = np.zeros(len(network.languages))
                for at in range(0, len(x), 1024):
                    part = x[at : at + 1024]
                    total += IS_LETTER[part].sum(axis=1) @ network.probabilities(part)
                if total.sum() <= 0:
                    total = network.probabilities(x[:1])[0].astype(float)
                best = int(total.argmax())
                named[i], scores[i] = network.languages[best], float(min(1.0, total[best] / total.sum()))
            return [pa.array(named, pa.string()), pa.array(scores, pa.float64())]

        return score

    return with_text_columns(docs, make, "lang_pred string, score double", text, keep)
