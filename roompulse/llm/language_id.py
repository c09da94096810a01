"""Language identification with a bidirectional gated recurrent network over bytes, in numpy.

A text is read in segments of ``SEGMENT`` bytes, all of them, side by side. In each direction a gated unit
carries ``HIDDEN`` values from byte to byte; at every position both states together give the probabilities of the
languages. A document's probabilities are the mean over all its positions, and its score is the greatest of them.

    z, r = sigmoid(W[byte] + U h)      n = tanh(Wn[byte] + r * (Un h))      h = n + z * (h - n)

The network is trained by backpropagation through time on windows of labelled documents: at most
``TRAIN_DOCS`` documents per language (drawn by a hash of the id) and ``TRAIN_WINDOWS`` windows of each. Only text
and label are learned from. Rows whose crc32 of the id has remainder ``HELD_OUT`` modulo 4 are never trained on.

NULL texts and texts without a letter are ``und`` with score 0; without any labelled row every text is. Rows with NULL
labels are predicted, not learned; repeated rows are each predicted; ties go to the first language by name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.llm import bytetext
from roompulse.llm.storage import documents, mapped, own_columns, saved

HIDDEN = 8
SEGMENT = 64
BATCH = 4096
TRAIN_DOCS = 500
TRAIN_WINDOWS = 6
HELD_OUT = 2
EPOCHS = 8
#: Steps of training at least, so that a small sample is gone through more often.
STEPS = 250
UNKNOWN = "und"

Weights = dict[str, np.ndarray]


def new_weights(languages: int, hidden: int = HIDDEN, seed: int = 7) -> Weights:
    """Per direction: byte table w (3 hidden x 256) and recurrence u (3 hidden x hidden); output o and its bias."""
    random = np.random.default_rng(seed)
    scale = 1 / np.sqrt(hidden)
    out: Weights = {"bias": np.zeros((languages, 1), np.float32)}
    for side in "fb":
        out["w" + side] = random.normal(0, 0.3, (3 * hidden, 256)).astype(np.float32)
        out["u" + side] = random.uniform(-scale, scale, (3 * hidden, hidden)).astype(np.float32)
        out["o" + side] = random.uniform(-scale, scale, (languages, hidden)).astype(np.float32)
    return out


def _states(x: np.ndarray, w: np.ndarray, u: np.ndarray, lengths: np.ndarray, backward: bool,
            keep: list | None = None) -> np.ndarray:
    """States after each position (time x hidden x batch); positions past a segment's end reset them to zero."""
    steps, batch = x.shape
    hidden = u.shape[1]
    out = np.empty((steps, hidden, batch), np.float32)
    state = np.zeros((hidden, batch), np.float32)
    shortest = int(lengths.min()) if batch else 0
    for t in range(steps - 1, -1, -1) if backward else range(steps):
        gates = np.take(w, x[t], axis=1)
        inner = u @ state
        both = gates[:2 * hidden]
        both += inner[:2 * hidden]
        both *= 0.5  # the logistic function by the hyperbolic tangent
        np.tanh(both, out=both)
        both *= 0.5
        both += 0.5
        z, r = both[:hidden], both[hidden:]
        n = gates[2 * hidden:]
        n += r * inner[2 * hidden:]
        np.tanh(n, out=n)
        new = out[t]
        np.subtract(state, n, out=new)
        new *= z
        new += n
        if t >= shortest:
            new *= lengths > t
        if keep is not None:
            keep.append((t, state, z.copy(), r.copy(), n.copy(), inner[2 * hidden:].copy()))
        state = new
    return out


def probabilities(x: np.ndarray, lengths: np.ndarray, weights: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each language at each position (time x languages x batch), and the states of both directions."""
    ahead = _states(x, weights["wf"], weights["uf"], lengths, False)
    back = _states(x, weights["wb"], weights["ub"], lengths, True)
    return _softmax(ahead, back, weights), ahead, back


def _softmax(ahead: np.ndarray, back: np.ndarray, weights: Weights) -> np.ndarray:
    scores = np.matmul(weights["of"], ahead)
    scores += np.matmul(weights["ob"], back)
    scores += weights["bias"]
    scores -= scores.max(axis=1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=1, keepdims=True)
    return scores


def gradients(x: np.ndarray, labels: np.ndarray, lengths: np.ndarray, weights: Weights) -> tuple[float, Weights]:
    """Mean cross-entropy over all positions, and its gradient by backpropagation through time."""
    trails: dict[str, list] = {"f": [], "b": []}
    states = {"f": _states(x, weights["wf"], weights["uf"], lengths, False, trails["f"]),
              "b": _states(x, weights["wb"], weights["ub"], lengths, True, trails["b"])}
    probs = _softmax(states["f"], states["b"], weights)
    live = (np.arange(x.shape[0])[:, None] < lengths).astype(np.float32)
    count = max(1.0, float(live.sum()))
    columns = np.arange(x.shape[1])
    loss = float(-(np.log(probs[:, labels, columns] + 1e-9) * live).sum() / count)
    error = probs.copy()
    error[:, labels, columns] -= 1
    error *= live[:, None, :] / count
    grads: Weights = {"bias": error.sum(axis=(0, 2))[:, None]}
    for side in "fb":
        u, hidden = weights["u" + side], weights["u" + side].shape[1]
        grads["o" + side] = np.einsum("tlb,thb->lh", error, states[side], optimize=True)
        into = np.matmul(weights["o" + side].T, error)
        grads["u" + side], table = np.zeros_like(u), np.zeros((256, 3 * hidden), np.float32)
        carried = np.zeros((hidden, x.shape[1]), np.float32)
        changes = np.empty((x.shape[0], 3 * hidden, x.shape[1]), np.float32)
        for t, state, z, r, n, inner in reversed(trails[side]):
            d = (into[t] + carried) * (lengths > t)
            dn = d * (1 - z) * (1 - n * n)
            change = changes[t]
            change[:hidden] = d * (state - n) * z * (1 - z)
            change[hidden:2 * hidden] = dn * inner * r * (1 - r)
            change[2 * hidden:] = dn
            through = change.copy()
            through[2 * hidden:] *= r
            grads["u" + side] += through @ state.T
            carried = d * z + u.T @ through
        order = np.argsort(x.ravel(), kind="stable")
        values = changes.transpose(0, 2, 1).reshape(-1, 3 * hidden)[order]
        seen, first = np.unique(x.ravel()[order], return_index=True)
        table[seen] = np.add.reduceat(values, first, axis=0)
        grads["w" + side] = table.T
    return loss, grads


def train(x: np.ndarray, lengths: np.ndarray, labels: np.ndarray, languages: int, epochs: int = EPOCHS,
          batch: int = 256, rate: float = 0.02, seed: int = 7) -> Weights:
    """Adam over shuffled minibatches of windows (time x window); a language's windows weigh alike by drawing evenly."""
    weights = new_weights(languages, seed=seed)
    random = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    epochs = max(epochs, -(-STEPS // -(-len(labels) // batch)))
    step, total = 0, epochs * -(-len(labels) // batch)
    for _ in range(epochs):
        order = random.permutation(len(labels))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            _, grads = gradients(x[:, pick], labels[pick], lengths[pick], weights)
            step += 1
            pace = rate * (1 - step / total) + 1e-4
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                weights[k] = (weights[k] - pace * (first[k] / (1 - 0.9 ** step))
                              / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return weights


def segments(data: np.ndarray, offsets: np.ndarray, size: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and length of the segments of all rows."""
    lengths = np.diff(offsets)
    parts = -(-lengths // size)
    row = np.repeat(np.arange(len(lengths)), parts)
    inner = bytetext.ragged(np.zeros(len(parts), np.int64), parts) * size
    return row, offsets[row] + inner, np.minimum(size, lengths[row] - inner)


def _columns(data: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """The segments side by side (time x segment), zero bytes after their ends' reach."""
    padded = np.concatenate([data, np.zeros(size, np.uint8)])
    return np.ascontiguousarray(padded[start[None, :] + np.arange(size)[:, None]])


def pooled(data: np.ndarray, offsets: np.ndarray, weights: Weights) -> np.ndarray:
    """Mean probabilities of each row (rows x languages) over all its positions."""
    row, start, length = segments(data, offsets)
    sums = np.zeros((len(offsets) - 1, weights["bias"].shape[0]))
    for at in range(0, len(row), BATCH):
        cut = slice(at, at + BATCH)
        probs, _, _ = probabilities(_columns(data, start[cut], SEGMENT), length[cut], weights)
        if int(length[cut].min()) < SEGMENT:
            probs *= (np.arange(SEGMENT)[:, None] < length[cut])[:, None, :]
        part = probs.sum(axis=0)
        for k in range(sums.shape[1]):
            sums[:, k] += np.bincount(row[cut], part[k], len(sums))
    return sums / np.maximum(np.diff(offsets), 1)[:, None]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == HELD_OUT


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
        train_docs: int = TRAIN_DOCS) -> tuple[list[str], Weights]:
    """Languages by name and trained weights, from a bounded sample of the labelled rows."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label")).where(
        ~held_out(F.col("doc_id")) & F.col("text").isNotNull() & (F.length("text") > 0) & F.col("label").isNotNull())
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return [], {}
    share = F.create_map(*(x for k in languages for x in (F.lit(k), F.lit(min(1.0, 1.2 * train_docs / counts[k])))))
    drawn = rows.where((F.pmod(F.xxhash64(F.lit("train"), "doc_id", "text"), F.lit(1 << 20)) / F.lit(1 << 20)) < share[F.col("label")])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytetext.utf8(batch["text"])
            labels, out = batch["label"].to_pylist(), []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                parts = -(-(b - a) // SEGMENT)
                for k in sorted({j * parts // TRAIN_WINDOWS for j in range(TRAIN_WINDOWS)}):
                    out.append((labels[i], data[a + k * SEGMENT:min(b, a + (k + 1) * SEGMENT)].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.binary())],
                                             names=["label", "window"])

    sample = drawn.transform(mapped, windows, "label string, window binary")
    found = sorted((r["label"], bytes(r["window"])) for r in sample.limit(2 * train_docs * TRAIN_WINDOWS * len(languages)).collect())
    if not found:
        return [], {}
    data = np.frombuffer(b"".join(w for _, w in found), np.uint8)
    lengths = np.array([len(w) for _, w in found])
    x = _columns(data, np.cumsum(lengths) - lengths, SEGMENT)
    labels = np.searchsorted(np.array(languages), np.array([k for k, _ in found]))
    return languages, train(x, lengths, labels, len(languages))


def predicted(docs: DataFrame, languages: list[str], weights: Weights, id_col: str = "doc_id", text_col: str = "text",
              carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang_pred and score of each row, and the columns to carry with ``own_`` before their names."""
    rows = documents(docs, id_col, text_col, carry).withColumn("letters", F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*languages, UNKNOWN], dtype=object)
        for batch in batches:
            data, offsets = bytetext.utf8(batch["text"])
            best = np.full(batch.num_rows, len(languages))
            score = np.zeros(batch.num_rows)
            if languages:
                for a, b in bytetext.slices(offsets):
                    probs = pooled(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], weights)
                    best[a:b], score[a:b] = probs.argmax(axis=1), np.minimum(probs.max(axis=1), 1.0)
            plain = ~batch["letters"].to_numpy(zero_copy_only=False)
            best[plain], score[plain] = len(languages), 0.0
            own = [c for c in batch.schema.names if c.startswith("own_")]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(names[best].tolist(), pa.string()), pa.array(score), *(batch[c] for c in own)],
                names=["doc_id", "lang_pred", "score", *own])

    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, lang_pred string, score double" + own_columns(rows)
    return rows.transform(mapped, run, schema)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on labelled rows that aren't held out, then predict all documents."""
    from roompulse.llm.storage import table

    docs = table(spark, sf_dir, "documents")
    languages, weights = fit(docs)
    return saved(predicted(docs, languages, weights).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"), "languages")
