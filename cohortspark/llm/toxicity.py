"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy (operator 9)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.llm.arrays import ALNUM, BYTE_CODE, LOWER, STEP, chunks, mix, owners, span_hashes, spans, text_bytes
from cohortspark.llm.frames import table, texts
from cohortspark.llm.labelled import PER_CLASS, held_out, labelled_sample

WINDOW = 32
HOP = 16
WIDTH = 16  # of a word's input
HIDDEN = 8  # of either direction
GRAM_SLOTS = 1 << 14  # at most 1 << 16, as slots are kept in 16 bits
GRAM_SIZES = (3, 5)
MIN_TEXTS = 5
THRESHOLD = 0.3
ROUNDS = 12
CHUNK = 4 << 20
SAMPLE_CHUNK = 1 << 18  # the fit runs on the driver, so its temporary arrays are kept to a few MB
WORDS_AT_ONCE = 1 << 16
DIFFERENT_AT_ONCE = 1 << 12


@dataclass
class Words:
    """The different words of a chunk: the chunk's words as indices, and each word's character grams as slots."""

    hashes: np.ndarray
    index: np.ndarray
    bounds: np.ndarray  # where each text's words begin
    slots: np.ndarray
    slot_bounds: np.ndarray


def read_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Lower-cased words without punctuation; grams of bytes, the word's ends marked."""
    data = LOWER[data]
    starts, ends, bounds = spans(data, offsets, ALNUM)
    hashes, first, index = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    sizes = (ends - starts)[first]
    begin = np.r_[0, np.cumsum(sizes + 2)]
    marked = np.zeros(begin[-1], np.uint64)
    inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    marked[np.repeat(begin[:-1] + 1, sizes) + inner] = BYTE_CODE[data[np.repeat(starts[first], sizes) + inner]]
    parts, owner = [], []
    where = np.repeat(np.arange(len(sizes)), sizes + 2)
    for n in GRAM_SIZES:
        gram = np.zeros(max(0, len(marked) - n + 1), np.uint64)
        for j in range(n if len(gram) else 0):
            gram = gram * STEP + marked[j : j + len(gram)]
        whole = where[: len(gram)] == where[n - 1 :] if len(gram) else np.zeros(0, bool)
        parts.append((mix(gram[whole] + np.uint64(n)) % np.uint64(GRAM_SLOTS)).astype(np.uint16))
        owner.append(where[: len(gram)][whole])
    owners_, slots = np.concatenate(owner), np.concatenate(parts)
    order = np.argsort(owners_, kind="stable")
    return Words(hashes, index, bounds, slots[order], np.searchsorted(owners_[order], np.arange(len(sizes) + 1)))


def slots_of(words: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slots of these words one after another, and each word's number of them."""
    low, high = words.slot_bounds[which], words.slot_bounds[which + 1]
    count = high - low
    return words.slots[np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)], count


def read_sample(sample: list[str]) -> Words:
    """As ``read_words`` of all texts, but read by runs of texts, whose words are brought together by their hashes."""
    data, offsets = text_bytes(pa.array(sample, pa.large_string()))
    seen, parts, slots, counts, bounds, total = np.zeros(0, np.uint64), [], [], [], [np.zeros(1, np.int64)], 0
    for a, b in chunks(offsets, SAMPLE_CHUNK):
        part = read_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        new = np.flatnonzero(~np.isin(part.hashes, seen))
        seen = np.r_[seen, part.hashes[new]]
        parts.append((part.hashes, part.index.astype(np.int32)))
        for held, found in zip((slots, counts), slots_of(part, new)):
            held.append(found)
        bounds.append(part.bounds[1:] + total)
        total += len(part.index)
    del data, part
    order = np.argsort(seen)
    hashes, count = seen[order], np.concatenate(counts)
    read = Words(seen, np.zeros(0, np.int32), np.zeros(0, np.int64), np.concatenate(slots), np.r_[0, np.cumsum(count)])
    index = np.concatenate([np.searchsorted(hashes, own).astype(np.int32)[at] for own, at in parts])
    sorted_ = [slots_of(read, order[a : a + DIFFERENT_AT_ONCE])[0] for a in range(0, max(1, len(order)), DIFFERENT_AT_ONCE)]
    return Words(hashes, index, np.concatenate(bounds), np.concatenate(sorted_), np.r_[0, np.cumsum(count[order])])


def text_counts(words: Words, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In how many texts each word stands, and in how many of label 1."""
    n = len(words.hashes)
    all_, yes = np.zeros(n, np.int64), np.zeros(n)
    for a, b in chunks(words.bounds, WORDS_AT_ONCE):
        part = slice(words.bounds[a], words.bounds[b])
        pairs = np.unique(owners(words.bounds[a : b + 1]) * np.int64(n + 1) + words.index[part])
        text, word = pairs // (n + 1), pairs % (n + 1)
        all_ += np.bincount(word, minlength=n)
        yes += np.bincount(word, labels[a:b][text], n)
    return all_, yes


def windows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and length of overlapping windows over every text, and each text's first window; no words, one empty one."""
    sizes = np.diff(bounds)
    count = np.maximum(1, -(-(sizes - (WINDOW - HOP)) // HOP))
    owner = np.repeat(np.arange(len(sizes)), count)
    begin = np.r_[0, np.cumsum(count)]
    at = (np.arange(begin[-1]) - begin[owner]) * HOP
    return bounds[:-1][owner] + at, np.minimum(WINDOW, sizes[owner] - at), begin


def sum_rows(values: np.ndarray, index: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows with each index below n."""
    out = np.zeros((n, values.shape[1]), values.dtype)
    if len(index):
        order = np.argsort(index, kind="stable")
        at = index[order]
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        out[at[starts]] = np.add.reduceat(values[order], starts)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Weights. Both directions are stacked on the first axis; gates are update, reset and candidate."""

    vocabulary: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # sorted hashes of known words
    w: dict[str, np.ndarray] = field(default_factory=dict)
    shift: float = 0.0  # from the sample's share of label 1 to that of all labelled rows

    @classmethod
    def fresh(cls, vocabulary: np.ndarray, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return cls(
            vocabulary,
            {
                "word": normal(len(vocabulary) + 1, WIDTH, scale=0.05),  # the last row: unknown words
                "gram": normal(GRAM_SLOTS, WIDTH, scale=0.05),
                "input": normal(2, WIDTH, 3 * HIDDEN, scale=WIDTH**-0.5),
                "bias": np.zeros((2, 1, 3 * HIDDEN), np.float32),
                "state": normal(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
                "attend": normal(2 * HIDDEN, HIDDEN, scale=HIDDEN**-0.5),
                "query": normal(HIDDEN, scale=HIDDEN**-0.5),
                "out": normal(2 * HIDDEN, scale=HIDDEN**-0.5),
                "base": np.zeros(1, np.float32),
            },
        )

    def known(self, hashes: np.ndarray) -> np.ndarray:
        size = len(self.vocabulary)
        if not size:
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), size - 1)
        return np.where(self.vocabulary[at] == hashes, at, size)

    def inputs(self, words: Words, which: np.ndarray | None = None) -> np.ndarray:
        """Each different word's vector: its embedding and the mean of its grams' embeddings, scaled."""
        low, high = words.slot_bounds[:-1], words.slot_bounds[1:]
        out = self.w["word"][self.known(words.hashes)]
        for a in range(0, len(low), DIFFERENT_AT_ONCE):
            b = min(a + DIFFERENT_AT_ONCE, len(low))
            if high[b - 1] > low[a]:
                values = self.w["gram"][words.slots[low[a] : high[b - 1]]]
                sums = np.add.reduceat(values, np.minimum(low[a:b] - low[a], len(values) - 1))
                out[a:b] += sums * ((high > low)[a:b] * np.maximum(1, high - low)[a:b] ** -0.5)[:, None].astype(np.float32)
        return out

    def run(self, projected: np.ndarray, sizes: np.ndarray, keep: bool = False):
        """Logits of windows. projected: (2, steps, windows, 3 * HIDDEN), the second direction in reversed order."""
        w, (_, steps, n, _) = self.w, projected.shape
        h = np.zeros((2, n, HIDDEN), np.float32)
        states, trace = np.zeros((2, steps, n, HIDDEN), np.float32), []
        for t in range(steps):
            a = h @ w["state"]
            x = projected[:, t]
            gates = sigmoid(x[..., : 2 * HIDDEN] + a[..., : 2 * HIDDEN])
            z, r = gates[..., :HIDDEN], gates[..., HIDDEN:]
            c = np.tanh(x[..., 2 * HIDDEN :] + r * a[..., 2 * HIDDEN :])
            there = (t < sizes)[None, :, None]
            new = np.where(there, h + z * (c - h), h)
            if keep:
                trace.append((h, a, z, r, c, there))
            h = new
            states[:, t] = h
        at = np.arange(steps)[:, None]
        back = np.maximum(sizes - 1 - at, 0)
        both = np.concatenate([states[0], states[1][back, np.arange(n)]], -1)  # (steps, windows, 2 * HIDDEN), in word order
        hidden = np.tanh(both @ w["attend"])
        score = np.where(at < sizes, hidden @ w["query"], -1e9)
        weight = np.exp(score - score.max(0)) * (at < sizes)
        weight = weight / np.maximum(weight.sum(0), 1e-9)
        pooled = (weight[..., None] * both).sum(0)
        logits = pooled @ w["out"] + w["base"]
        return (logits, (trace, back, both, hidden, weight, pooled)) if keep else logits

    def gather(self, table: np.ndarray, index: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Projections of the windows' words; places behind a window's end take any word and are masked later."""
        at = np.arange(WINDOW)[:, None]
        top = max(len(index) - 1, 0)
        ahead = index[np.minimum(first + at, top)]
        back = index[np.clip(first + sizes - 1 - at, 0, top)]
        return np.stack([table[0][ahead], table[1][back]])

    def logits(self, words: Words, first: np.ndarray, sizes: np.ndarray, block: int = 512) -> np.ndarray:
        out = np.empty(len(first), np.float32)
        if not len(words.index):
            out[:] = self.w["base"]
            return out
        table = self.inputs(words) @ self.w["input"]
        table += self.w["bias"]
        for a in range(0, len(first), block):
            part = slice(a, a + block)
            out[part] = self.run(self.gather(table, words.index, first[part], sizes[part]), sizes[part])
        return out

    def logits_by_runs(self, words: Words, first: np.ndarray, sizes: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """As ``logits``, with the projections of one run of texts held at a time. begin: each text's first window."""
        out = np.empty(len(first), np.float32)
        for a, b in chunks(words.bounds, WORDS_AT_ONCE):
            low, part = words.bounds[a], slice(begin[a], begin[b])
            used, place = np.unique(words.index[low : words.bounds[b]], return_inverse=True)
            slots, count = slots_of(words, used)
            own = Words(words.hashes[used], place, words.bounds[a : b + 1] - low, slots, np.r_[0, np.cumsum(count)])
            out[part] = self.logits(own, first[part] - low, sizes[part])
        return out

    def step(self, words: Words, first: np.ndarray, sizes: np.ndarray, y: np.ndarray, drop: np.random.Generator) -> dict:
        """Gradients of the mean log loss over these windows, by back-propagation through time."""
        w = self.w
        n, grad = len(first), {k: np.zeros_like(v) for k, v in w.items()}
        at = np.arange(WINDOW)[:, None]
        top = max(len(words.index) - 1, 0)
        ahead = words.index[np.minimum(first + at, top)]
        used, place = np.unique(ahead, return_inverse=True)
        place = place.reshape(ahead.shape)
        slots, count = slots_of(words, used)
        owner = np.repeat(np.arange(len(used)), count)
        scale = (np.maximum(count, 1) ** -0.5).astype(np.float32)
        ids = self.known(words.hashes[used])
        ids = np.where(drop.random(len(ids)) < 0.3, len(w["word"]) - 1, ids)  # some words are known by their grams only
        x = w["word"][ids].copy()
        x += sum_rows(w["gram"][slots] * scale[owner][:, None], owner, len(x))
        table = x @ w["input"] + w["bias"]
        back_at = np.clip(sizes - 1 - at, 0, WINDOW - 1)
        place_back = place[back_at, np.arange(n)]
        projected = np.stack([table[0][place], table[1][place_back]])
        logits, (trace, back, both, hidden, weight, pooled) = self.run(projected, sizes, keep=True)
        d = (sigmoid(logits) - y)[:, None] / n
        grad["base"][:] = d.sum()
        grad["out"][:] = (d * pooled).sum(0)
        d_pooled = d * w["out"]
        d_both = weight[..., None] * d_pooled
        d_weight = (both * d_pooled).sum(-1)
        d_score = weight * (d_weight - (weight * d_weight).sum(0))
        grad["query"][:] = np.einsum("tnk,tn->k", hidden, d_score)
        d_hidden = d_score[..., None] * w["query"] * (1 - hidden**2)
        grad["attend"][:] = np.einsum("tnd,tnk->dk", both, d_hidden)
        d_both += d_hidden @ w["attend"].T
        d_states = np.zeros((2, WINDOW, n, HIDDEN), np.float32)
        d_states[0] = d_both[..., :HIDDEN]
        inside = (at < sizes)[..., None]
        d_states[1] = d_both[back, np.arange(n), HIDDEN:] * inside
        d_inputs = np.zeros_like(projected)
        carry = np.zeros((2, n, HIDDEN), np.float32)
        for t in range(WINDOW - 1, -1, -1):
            h, a, z, r, c, there = trace[t]
            carry = carry + d_states[:, t]
            now = carry * there
            dc = now * z * (1 - c**2)
            dr = dc * a[..., 2 * HIDDEN :] * r * (1 - r)
            dz = now * (c - h) * z * (1 - z)
            da = np.concatenate([dz, dr, dc * r], -1)
            dx = np.concatenate([dz, dr, dc], -1)
            grad["state"] += np.swapaxes(h, 1, 2) @ da
            carry = np.where(there, now * (1 - z), carry) + da @ np.swapaxes(w["state"], 1, 2)
            d_inputs[:, t] = dx
        flat = d_inputs.reshape(2, -1, 3 * HIDDEN)
        d_table = np.stack([sum_rows(v, p.reshape(-1), len(x)) for v, p in zip(flat, (place, place_back))])
        grad["bias"][:] = d_table.sum(1, keepdims=True)
        grad["input"][:] = x.T @ d_table
        d_x = (d_table @ np.swapaxes(w["input"], 1, 2)).sum(0)
        grad["word"] = sum_rows(d_x, ids, len(w["word"]))
        grad["gram"] = sum_rows(d_x[owner] * scale[owner][:, None], slots, GRAM_SLOTS)
        return grad


def telling(all_: np.ndarray, yes: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Each word's log odds of standing in texts of label 1, by counts of texts."""
    return np.log((yes + 0.5) / (labels.sum() + 1)) - np.log((all_ - yes + 0.5) / (len(labels) - labels.sum() + 1))


def fit_network(sample: list[str], labels: list[int], share: float, rounds: int = ROUNDS, seed: int = 7) -> Network:
    """A text is as toxic as its most toxic window: each round takes every text's highest window (in the first rounds the
    window with the most telling word) and, of texts of label 0, a random one too. Without both labels every score is the share.
    """
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        net = Network.fresh(np.zeros(0, np.uint64))
        net.w["out"][:] = 0
        net.shift = float(np.log(max(share or 0.0, 1e-6) / max(1 - (share or 0.0), 1e-6)))
        return net
    words = read_sample(sample)
    counts = text_counts(words, y)
    net = Network.fresh(words.hashes[counts[0] >= MIN_TEXTS], seed)
    first, sizes, begin = windows(words.bounds)
    owner = owners(begin)
    odds = telling(*counts, y)
    reach = np.array([odds[words.index[a : a + n]].max(initial=-9) for a, n in zip(first, sizes)])
    rng = np.random.default_rng(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.w.items()}
    count = 0
    for turn in range(rounds):
        value = reach if turn < 3 else net.logits_by_runs(words, first, sizes, begin)
        order = np.lexsort((rng.random(len(value)), value, owner))
        top = order[begin[1:] - 1]
        other = (begin[:-1] + (rng.random(len(y)) * np.diff(begin)).astype(int))[y == 0]
        chosen = rng.permutation(np.r_[top, other])
        for a in range(0, len(chosen), 128):
            part = chosen[a : a + 128]
            grad = net.step(words, first[part], sizes[part], y[owner[part]], rng)
            count += 1
            rate = 0.01 * min(1.0, 2 * (1 - turn / rounds))
            for k, g in grad.items():
                m, v = moments[k]
                g = g + (1e-5 if k in ("word", "gram") else 0) * net.w[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                net.w[k] -= rate * (m / (1 - 0.9**count)) / (np.sqrt(v / (1 - 0.999**count)) + 1e-7)
    mean = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    net.shift = float(np.log(share / (1 - share)) - np.log(mean / (1 - mean)))
    return net


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Network:
    """Fitted on a bounded labelled sample (see ``labelled_sample``); held-out rows are excluded."""
    return fit_network(*labelled_sample(docs, labels, "toxic", per_class))


def text_scores(net: Network, column: pa.Array) -> np.ndarray:
    """Scores of whole texts, the maximum over all their overlapping windows."""
    data, offsets = text_bytes(column)
    out = np.zeros(len(offsets) - 1)
    for a, b in chunks(offsets, CHUNK):
        words = read_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        first, sizes, begin = windows(words.bounds)
        logits = net.logits(words, first, sizes)
        out[a:b] = sigmoid(np.maximum.reduceat(logits, begin[:-1]).astype(float) + net.shift)
    return out


def score_toxicity(
    docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """(doc_id, score, predicted) of every row; map only. Null and empty texts are one empty window. Rows with equal or null
    ids are scored one by one."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = text_scores(net, batch.column(1))
            predicted = pa.array((score >= threshold).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), predicted], ["doc_id", "score", "predicted"])

    return texts(docs, id_col, text_col).mapInArrow(work, "doc_id long, score double, predicted int")


def drop_toxic(docs: DataFrame, net: Network, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows, all columns as they are, whose text scores below the threshold."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            yield batch.filter(pa.array(text_scores(net, column) < threshold))

    return docs.mapInArrow(work, docs.schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", F.col("predicted"))


QUERIES = {"op9_toxicity": op9_toxicity}
