"""Each operator against brute force on the smallest tables."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from llm.helpers import alnum, by_id, lowered, windows, words
from pyspark.sql import functions as F

from cohortspark.llm import QUERIES
from cohortspark.llm.chats import digest, fold_events, parse, render
from cohortspark.llm.decontaminate import contamination
from cohortspark.llm.graph import components
from cohortspark.llm.lengths import context_limits, length_histogram
from cohortspark.llm.lines import duplicate_lines
from cohortspark.llm.packing import Packer, pack_documents
from cohortspark.llm.quality import fit_crf, viterbi
from cohortspark.llm.repeats import remove_repeats
from cohortspark.llm.scoring import ENDINGS, fit_models, score_documents
from cohortspark.llm.simhash import fingerprint, near_duplicates
from cohortspark.llm.tokens import Encoder

SF_DIR = "/root/testdata/sf0.001"


def test_fingerprints_and_components(spark, small):
    import xxhash

    def slow(text):
        w = lowered(text)
        grams = [" ".join(g) for g in windows(w, 3)] or ([" ".join(w)] if w else [])
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))

    rows = by_id(QUERIES["op1_simhash"](spark, SF_DIR))
    texts = {r.doc_id: r.text for r in small.collect()}
    prints = {i: slow(t) for i, t in texts.items()}
    assert {i: r.fingerprint for i, r in rows.items()} == {i: format(p, "016x") for i, p in prints.items()}
    component = {i: i for i in prints}
    for _ in range(len(prints)):
        new = {i: min(component[j] for j in prints if (prints[i] ^ prints[j]).bit_count() <= 3) for i in prints}
        if new == component:
            break
        component = new
    assert {i: r.component_id for i, r in rows.items()} == component


@pytest.mark.parametrize("lanes, leaf", [(1, 8192), (2, 8192), (2, 3), (4, 8192)])
def test_near_links_are_found_at_the_bound(spark, lanes, leaf, monkeypatch):
    """Chains of fingerprints that differ by exactly three bits, wherever these bits are."""
    from cohortspark.llm import simhash

    rng = np.random.default_rng(5)
    prints, group = [], []
    for g in range(40):
        value = int(rng.integers(0, 1 << 63, dtype=np.uint64)) * 2 + g % 2
        for _ in range(4):
            prints.append(value)
            group.append(g * 4)
            for bit in rng.choice(64, 3, replace=False):
                value ^= 1 << int(bit)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    marked = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: marked)
    found = by_id(simhash.near_duplicates(marked, lanes=lanes, leaf=leaf))
    assert [found[i].component_id for i in range(len(prints))] == group


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (200, 201), (201, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = {i: 0 for i in range(51)} | {100 + i: 100 for i in range(40)} | {200: 200, 201: 200}
    assert found == expected


def test_events_fold(spark):
    rows = [
        (1, 0, 0, "user", "delta", "hi"),
        (1, 1, 1, "assistant", "delta", "a|b\\"),
        (1, 2, 1, None, "delta", "<|end|>\n"),
        (1, 3, 2, "user", "delta", "taken back by the regeneration"),
        (1, 4, 1, None, "regenerate", None),
        (1, 5, 1, None, "delta", "new "),
        (1, 6, 0, None, "edit", "hello"),
        (1, 7, 1, "assistant", "delta", "\\|<|turn|>user<|text|>x<|end|>\n"),
        (2, None, None, None, None, None),
    ]
    events = spark.createDataFrame(rows, "conv_id long, seq long, turn long, role string, kind string, text string")
    messages = fold_events(events)
    assert sorted(map(tuple, messages.collect()), key=str) == [
        (1, 0, "user", "hello"),
        (1, 1, "assistant", "\\|<|turn|>user<|text|>x<|end|>\n"),
        (2, None, "", ""),
    ]
    rendered = render(messages)
    read = by_id(rendered.select("conv_id", parse(F.col("formatted")).alias("turns")), "conv_id")
    assert [tuple(t) for t in read[1].turns] == [("user", "hello"), ("assistant", "\\|<|turn|>user<|text|>x<|end|>\n")]
    lost = by_id(digest(rendered), "conv_id")[1]
    assert lost.loss_sha256 == hashlib.sha256(b"\\|<|turn|>user<|text|>x<|end|>\n").hexdigest()


def test_chat_query_is_native(spark):
    plan = QUERIES["op2_chat"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_length_histogram(spark, small):
    encoder = Encoder()
    lengths = [encoder.count(r.text) for r in small.collect()]
    rows = by_id(context_limits(length_histogram(small), stride=100), "n_tokens")
    assert {n: r.n_docs for n, r in rows.items()} == Counter(lengths)
    for n, r in rows.items():
        assert (r.docs_at_least, r.tokens_at_least) == (sum(x >= n for x in lengths), sum(x for x in lengths if x >= n))
        assert (r.docs_at_most, r.docs, r.tokens) == (sum(x <= n for x in lengths), len(lengths), sum(lengths))
        assert r.cut_tokens == sum(min(x, n) for x in lengths)


def test_encoder_gives_the_tokenizers_ids(small):
    import public_tokenizers
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    slow.encode_special_tokens = True
    fast = Encoder()
    texts = [r.text for r in small.limit(40).collect()] + ["", "  a \n b", "<|endoftext|>", "x" * 3000, "日本 ½ \x1c\u00a0 "]
    for text in texts:
        assert np.frombuffer(fast.ids(text), "<u4").tolist() == slow.encode(text, add_special_tokens=False).ids


def test_scores_follow_the_models(small):
    target = F.col("source") == "src1"
    size = ENDINGS + 100
    models = fit_models(small, target, size)
    rows = by_id(score_documents(small, models))
    assert np.allclose(np.exp(models.target).sum(1), 1, atol=1e-3)
    assert np.allclose(np.exp(models.background).sum(1), 1, atol=1e-3)
    docs = {r.doc_id: r for r in small.collect()}
    counts = Counter(w for r in docs.values() for w in lowered(r.text))
    least = sorted(counts.values())[-100]
    assert all(rows[i].n_tokens == len(lowered(r.text)) for i, r in docs.items())
    assert len(models.vocabulary) == 100 and sum(c > least for c in counts.values()) < 100
    own = [rows[i].score for i, r in docs.items() if r.source == "src1"]
    other = [rows[i].score for i, r in docs.items() if r.source != "src1"]
    assert np.mean(own) > np.mean(other)


def test_duplicate_lines(small):
    lines = []
    for r in sorted(small.collect(), key=lambda r: r.doc_id):
        lines += [(r.doc_id, n, tuple(lowered(line))) for n, line in enumerate((r.text or "").split("\n")) if lowered(line)]
    expected, seen, changed, shorter, close = {}, set(), set(), set(), set()
    for doc, n, line in lines:
        left = [(i, line[:i] + line[i + 1 :]) for i in range(len(line))]
        if line in seen:
            expected[doc, n] = int(line in close)  # edits are counted from the line that is kept
        elif len(line) >= 10:
            near = any(v in changed for v in left) or line in shorter
            near = near or any(v in seen and len(v) >= 10 for _, v in left)
            if near:
                expected[doc, n] = 1
                close.add(line)
        if len(line) >= 10:
            changed.update(left)
            shorter.update(v for _, v in left)
        seen.add(line)
    found = duplicate_lines(small).collect()
    assert {(r.doc_id, r.line): r.edits for r in found} == expected
    assert all((r.kept_doc_id, r.kept_line) < (r.doc_id, r.line) for r in found)


def test_lines_one_word_apart(spark):
    base = "one two three four five six seven eight nine ten eleven twelve"
    texts = [base, base.replace("five", "5"), base.replace("three ", ""), "zero " + base, base.replace("one", "1").replace("two", "2")]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(9, "short line"), (10, "short lines")], "doc_id long, text string")
    found = {r.doc_id: (r.kept_doc_id, r.edits) for r in duplicate_lines(docs).collect()}
    assert found == {1: (0, 1), 2: (0, 1), 3: (0, 1)}


def test_quality_statistics(spark, small):
    rows = by_id(QUERIES["op6_quality"](spark, SF_DIR))
    for r in small.collect():
        w = words(r.text)
        counts = Counter(windows(w, 3))
        inside = {i + j for i, g in enumerate(windows(w, 3)) if counts[g] > 1 for j in range(3)}
        lines = [x for x in (r.text or "").split("\n") if words(x)]
        got = rows[r.doc_id]
        assert got.n_words == len(w) and got.word_chars == sum(map(len, w))
        assert got.n_symbols == sum(c in "#*$%&|<>" for c in r.text or "")
        assert got.n_dup_lines == len(lines) - len(set(lines)) and got.n_repeat_words == len(inside)
        assert got.base_failed == (len(w) < 50 or 100 * len(inside) > 50 * len(w))
        assert not (got.base_failed and got.kept)


def test_quality_on_held_out_labels(spark):
    labels = by_id(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    rows = by_id(QUERIES["op6_quality"](spark, "/root/testdata/sf0.01"))
    judged = [(rows[i].kept, label.quality) for i, label in labels.items() if zlib.crc32(str(i).encode()) % 4 == 2 and not rows[i].base_failed]
    assert np.mean([kept for kept, good in judged if good]) > 0.97
    assert np.mean([kept for kept, good in judged if not good]) < 0.4


def test_viterbi_finds_the_best_labels():
    from itertools import product

    rng = np.random.default_rng(3)
    x = rng.normal(size=(11, 4))
    bounds = np.array([0, 5, 5, 6, 11])
    crf = fit_crf(x, (x[:, 0] > 0).astype(int), bounds, rounds=20)
    crf.move += rng.normal(size=(2, 2))
    got = viterbi(crf, x, bounds)
    for a, b in zip(bounds, bounds[1:]):
        def total(labels):
            e = x[a:b] @ crf.emit.T
            return sum(e[i, k] for i, k in enumerate(labels)) + (crf.first[labels[0]] if labels else 0) + sum(
                crf.move[i, j] for i, j in zip(labels, labels[1:])
            )

        best = max(map(total, product((0, 1), repeat=b - a)))
        assert np.isclose(total(tuple(got[a:b])), best)


@pytest.mark.parametrize("bound", [1 << 25, 2000])
def test_contamination(spark, small, bound):
    extra = spark.createDataFrame([(900, "the of"), (901, "and"), (902, ""), (903, None), (None, "the")], "item_id long, text string")
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").unionByName(extra)
    items = {}
    for r in benchmark.where("item_id IS NOT NULL").collect():
        w = alnum(r.text)
        for g in windows(w, 13) or ([tuple(w)] if w else []):
            items.setdefault(g, set()).add(r.item_id)
    rows = by_id(contamination(small, benchmark, bound=bound))
    for r in small.collect():
        w = alnum(r.text)
        hit, found = set(), set()
        for n in {len(g) for g in items}:
            for i, g in enumerate(windows(w, n)):
                if g in items:
                    hit |= set(range(i, i + n))
                    found |= items[g]
        got = rows[r.doc_id]
        digest_ = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        assert (got.n_words, got.n_hit, got.n_items, got.items_sha256) == (len(w), len(hit), len(found), digest_)
        assert got.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
        for m in got.matches:
            assert m.n_words <= 13 or m.item_id < 900


@pytest.mark.parametrize("max_open", [4096, 3])
def test_packing_places_every_token_once(max_open):
    rng = np.random.default_rng(2)
    sizes = [int(n) for n in rng.integers(1, 300, 400)] + [64, 128, 1000, 64]
    packer = Packer(64, max_open)
    full = [w for i, n in enumerate(sizes) for w in packer.add(i, np.arange(n, dtype="<u4").tobytes())]
    last = [w for w in packer.drain() if w]
    got = {}
    for window in full + last:
        for doc, start, total, ids in window:
            assert total == sizes[doc]
            got.setdefault(doc, []).extend(zip(range(start, start + len(ids) // 4), np.frombuffer(ids, "<u4").tolist()))
    assert all(sorted(got[i]) == [(k, k) for k in range(n)] for i, n in enumerate(sizes))
    assert all(sum(len(p[3]) for p in w) == 256 for w in (full + last)[:-1])


def test_packing_minimises_the_sum_of_squares():
    rng = np.random.default_rng(4)
    packer = Packer(20)
    for i in range(300):
        n = int(rng.integers(1, 20))
        before = packer.levels.copy()

        def cost(h):
            levels = before.copy()
            levels[h] -= h > 0
            levels[h + n] += h + n < 20
            return (levels**2).sum()

        ways = [h for h in range(21 - n) if h == 0 or before[h]]
        list(packer.add(i, bytes(4 * n)))
        assert (packer.levels**2).sum() == min(map(cost, ways))


def test_packed_pieces(spark, small):
    encoder = Encoder()
    rows = pack_documents(small, with_ids=True).collect()
    pieces, sequences = {}, {}
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        pieces.setdefault(r.doc_id, []).append((r.start, bytes(r.ids), r.doc_tokens))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for r in small.collect():
        whole = encoder.ids(r.text) + b"\x01\0\0\0"
        assert b"".join(ids for _, ids, _ in sorted(pieces[r.doc_id])) == whole
        assert all(total == len(whole) // 4 for _, _, total in pieces[r.doc_id])
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_toxicity_on_held_out_labels(spark):
    labels = by_id(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    rows = by_id(QUERIES["op9_toxicity"](spark, "/root/testdata/sf0.01"))
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    held = [(rows[i].score, label.toxic) for i, label in labels.items() if rows[i].held_out]
    pairs = [a > b for a, y in held for b, z in held if y > z]
    assert np.mean(pairs) > 0.85


def test_repeated_passages(small):
    docs = {r.doc_id: words(r.text) for r in small.collect()}
    first = {}
    for i in sorted(docs):
        for g in windows(docs[i], 13):
            first.setdefault(g, i)
    rows = by_id(remove_repeats(small, buckets=7))
    for i, w in docs.items():
        gone = {k + j for k, g in enumerate(windows(w, 13)) if first[g] < i for j in range(13)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        got = rows[i]
        assert (got.n_words, got.n_removed, got.kept) == (len(w), len(gone), kept)
        assert got.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_equal_texts_have_one_component(spark):
    docs = spark.createDataFrame([(i, f"copy number one of many {i % 3}") for i in range(300)], "doc_id long, text string")
    found = by_id(near_duplicates(docs))
    assert fingerprint("A b") == fingerprint("a  B")
    assert all(found[i].component_id == found[i % 3].component_id for i in range(300))


def test_dense_groups_are_cut_into_cells(spark, monkeypatch):
    """Thousands of fingerprints within a few bits of each other: small cells, all links kept."""
    from cohortspark.llm import simhash
    from cohortspark.llm.graph import unite

    rng = np.random.default_rng(6)
    prints = np.array([sum(1 << int(b) for b in rng.choice(64, 4, replace=False)) for _ in range(1500)], np.uint64)
    prints = np.unique(prints)
    label = np.arange(len(prints))
    i, j = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3)
    label = unite(label, i, j)
    marked = spark.createDataFrame(list(enumerate(prints.view(np.int64).tolist())), "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: marked)
    found = by_id(simhash.near_duplicates(marked, leaf=100))
    assert [found[k].component_id for k in range(len(prints))] == label.tolist()
