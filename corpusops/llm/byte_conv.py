"""Language identification by a byte convolutional network.

Bytes are embedded, filters of several widths slide over windows of fixed length, each filter keeps
its largest response, and a softmax layer tells languages. The network is trained in numpy on
labelled text; a text's prediction is the mean over all its windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusops.llm.words import slices

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDING = 6
# what trains the network: of each language the first so many texts by a hash, and of each text so many windows
FIT_DOCS = 1000
FIT_WINDOWS = 2
PASSES = 8
BATCH = 64
UNKNOWN = "und"


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    def responses(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest response of each filter per window, and where it is."""
        embedded = self.embed[windows]
        tops, places = [], []
        for width, filters, bias in zip(WIDTHS, self.filters, self.biases):
            n = windows.shape[1] - width + 1
            total = embedded[:, :n] @ filters[:EMBEDDING]
            for j in range(1, width):
                total += embedded[:, j : j + n] @ filters[j * EMBEDDING : (j + 1) * EMBEDDING]
            place = total.argmax(axis=1)
            top = np.take_along_axis(total, place[:, None], 1)[:, 0] + bias
            tops.append(np.maximum(top, 0))
            places.append(place)
        return np.concatenate(tops, 1), places

    def log_chances(self, windows: np.ndarray) -> np.ndarray:
        z = self.responses(windows)[0] @ self.out + self.out_bias
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], passes: int = PASSES, seed: int = 7) -> Network:
    """Adam over cross-entropy; only each filter's largest response carries a gradient."""
    draw = np.random.default_rng(seed)
    scaled = lambda *shape: draw.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
    net = Network(
        languages,
        draw.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        [scaled(w * EMBEDDING, FILTERS) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        scaled(FILTERS * len(WIDTHS), len(languages)),
        np.zeros(len(languages), np.float32),
    )
    params = [net.embed, *net.filters, *net.biases, net.out, net.out_bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(passes):
        order = draw.permutation(len(windows))
        for low in range(0, len(order), BATCH):
            at = order[low : low + BATCH]
            batch, hidden_places = windows[at], None
            hidden, hidden_places = net.responses(batch)
            z = hidden @ net.out + net.out_bias
            chance = np.exp(z - z.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            chance[np.arange(len(at)), labels[at]] -= 1
            error = (chance / len(at)).astype(np.float32)
            back = (error @ net.out.T) * (hidden > 0)
            grad_embed = np.zeros_like(net.embed)
            grad_filters, grad_biases = [], []
            for i, (width, filters, place) in enumerate(zip(WIDTHS, net.filters, hidden_places)):
                part = back[:, i * FILTERS : (i + 1) * FILTERS]
                spots = place[:, :, None] + np.arange(width)
                seen = batch[np.arange(len(at))[:, None, None], spots]
                patches = net.embed[seen].reshape(len(at), FILTERS, -1)
                grad_filters.append(np.einsum("bf,bfw->wf", part, patches))
                grad_biases.append(part.sum(axis=0))
                flow = (part[:, :, None] * filters.T[None]).reshape(len(at), FILTERS, width, EMBEDDING)
                np.add.at(grad_embed, seen, flow)
            step += 1
            for p, g, a, b in zip(params, [grad_embed, *grad_filters, *grad_biases, hidden.T @ error, error.sum(axis=0)], first, second):
                a *= 0.9
                a += 0.1 * g
                b *= 0.999
                b += 0.001 * g * g
                p -= 0.01 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return net


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of all texts in rows of WINDOW, the last of a text filled with spaces, and each row's text."""
    sizes = np.diff(offsets)
    rows = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), rows)
    first = np.concatenate([[0], np.cumsum(rows)])
    out = np.full(first[-1] * WINDOW, 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(first[:-1] * WINDOW - offsets[:-1], sizes)] = data
    return out.reshape(-1, WINDOW), owner


def fitted(docs: DataFrame, trains: Column, text: str, lang: str) -> Network | None:
    """The network trained on rows where ``trains`` holds; None without any.

    Windows lie anywhere in a text, by hashes of it, so what all texts begin with teaches nothing.
    The driver gets at most some ``2 * FIT_DOCS`` rows of each language, and no more of a text than its windows.
    """
    value, name = F.col(f"`{text}`"), F.col(f"`{lang}`")
    rows = docs.where(trains & name.isNotNull() & (F.octet_length(value) > 0)).select(name.alias("lang"), value.alias("text"))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    # a draw below its language's share is taken: as many rows as the network has outputs are sent out
    shares = rows.sparkSession.createDataFrame([(x, min(1.0, 2 * FIT_DOCS / n)) for x, n in counts.items()], "lang string, share double")
    drawn = rows.withColumn("draw", F.shiftrightunsigned(F.xxhash64("text", F.lit(11)), 11))
    taken = drawn.join(F.broadcast(shares), "lang").where(F.col("draw") / float(1 << 53) <= F.col("share"))
    room = F.greatest(F.char_length("text") - WINDOW, F.lit(0)) + 1
    at = [F.pmod(F.xxhash64("text", F.lit(i)), room).cast("int") + 1 for i in range(FIT_WINDOWS)]
    cut = F.array_distinct(F.array(*[F.substr(F.col("text"), a, F.lit(WINDOW)) for a in at]))
    # of copies one
    found = taken.select("lang", "draw", cut.alias("windows")).distinct().collect()
    chosen: dict[str, list] = {}
    for r in sorted(found, key=lambda r: (r.draw, r.windows)):
        chosen.setdefault(r.lang, []).append(r.windows)
    place = {x: i for i, x in enumerate(languages)}
    windows, labels = [], []
    for nth in range(FIT_DOCS):
        for name, texts in sorted(chosen.items()):
            for piece in texts[nth] if nth < len(texts) else ():
                # characters of several bytes make a piece longer than a window
                data = np.frombuffer(piece.encode(), np.uint8)[:WINDOW]
                windows.append(cut_windows(data, np.array([0, len(data)]))[0][0])
                labels.append(place[name])
    return train(np.stack(windows), np.array(labels), languages)


def predict(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row.

    Training rows are those with a language where ``held_out`` is false; the fit takes at most
    ``FIT_DOCS`` distinct texts of each language and ``FIT_WINDOWS`` windows of each. A text without letters, empty or null, is ``und`` with score 0, as
    is every text if nothing could be learned. Predictions see the text only; repeated rows are
    predicted alike, and of languages that are equally likely the first by name is named; rows without
    an id are kept; an empty table gives no rows.
    """
    net = fitted(docs, ~F.coalesce(held_out, F.lit(True)), text, lang)
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(True)).alias("held_out"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text", 1 << 18):
            n = batch.num_rows
            names, score = np.full(n, UNKNOWN, object), np.zeros(n)
            plain = (texts.data | 32) - np.uint8(97) < 26
            seen = np.concatenate([[0], np.cumsum(plain)])[texts.offsets]
            letters = np.diff(seen) > 0
            for j in np.flatnonzero(~letters & (np.diff(texts.offsets) > 0)):
                letters[j] = any(c.isalpha() for c in texts.data[texts.offsets[j] : texts.offsets[j + 1]].tobytes().decode())
            if net is not None and len(texts.data):
                windows, owner = cut_windows(texts.data, texts.offsets)
                total = np.zeros((n, len(net.languages)))
                for low in range(0, len(windows), 128):
                    np.add.at(total, owner[low : low + 128], net.log_chances(windows[low : low + 128]))
                mean = total / np.maximum(1, np.bincount(owner, minlength=n))[:, None]
                chance = np.exp(mean - mean.max(axis=1, keepdims=True))
                chance /= chance.sum(axis=1, keepdims=True)
                best = chance.argmax(axis=1)
                names = np.where(letters, np.array(net.languages, object)[best], UNKNOWN)
                score = np.where(letters, chance[np.arange(n), best], 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names.tolist(), pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"]
            )

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
