"""The toxicity model: memory of a fit on the driver, and texts without words."""

import tracemalloc

import numpy as np
import pyarrow as pa

from cohortspark.llm.toxicity import Network, fit_network, text_scores


def sample(texts: int, words: int) -> tuple[list[str], list[int]]:
    rng = np.random.default_rng(3)
    known = [f"word{i:x}" for i in rng.integers(0, 1 << 40, 80_000)]
    return [" ".join(known[i] for i in rng.integers(0, len(known), words)) for _ in range(texts)], [k % 2 for k in range(texts)]


def test_a_fit_holds_few_times_its_sample():
    texts, labels = sample(400, 1200)
    size = sum(map(len, texts))
    tracemalloc.start()
    net = fit_network(texts, labels, 0.1, rounds=4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(net.vocabulary) > 30_000 and peak < 12 * size + (20 << 20), (peak, size)


def test_a_batch_without_words():
    net = Network.fresh(np.arange(3, dtype=np.uint64))
    assert text_scores(net, pa.array(["", " \n", None])).tolist() == [0.5] * 3
    texts = ["", "bad words", *[" " * (1 << 18)] * 2, "good words"]
    assert np.isfinite(text_scores(fit_network(texts, [0, 1, 0, 0, 0], 0.2, rounds=4), pa.array(texts))).all()
