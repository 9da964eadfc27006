"""Models and queries against plain loops that follow the definitions."""

import itertools
import math
import random
import re
from collections import defaultdict

import numpy as np
import xxhash

from corpusops.llm import best_fit, byte_conv, simhash_trie, weak_labels

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components_equal_brute_force(spark):
    draw = random.Random(9)
    texts = []
    for _ in range(12):
        base = [f"w{draw.randrange(10**6)}" for _ in range(draw.choice([2, 40, 300]))]
        for edits in (0, 0, 1, 1, 2, 3):
            copy = list(base)
            for _ in range(edits):
                copy[draw.randrange(len(copy))] = f"X{draw.randrange(10**6)}"
            texts.append(" ".join(copy).upper() if edits == 1 else " ".join(copy))
    texts += [None, "", " \n"]
    rows = [(1000 - 7 * i, t) for i, t in enumerate(texts)]
    marks = {i: fingerprint(t) for i, t in rows}
    parent = {i: i for i in marks}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(marks, 2):
        if (marks[a] ^ marks[b]).bit_count() <= 2:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    found = simhash_trie.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in found.collect()} == {i: find(i) for i in marks}
    assert len({find(i) for i in marks}) < len({marks[i] for i in marks})


def test_filters_respond_as_a_plain_loop_does():
    draw = np.random.default_rng(3)
    net = byte_conv.train(draw.integers(97, 123, (12, byte_conv.WINDOW)).astype(np.uint8), np.arange(12) % 3, ["a", "b", "c"], passes=1)
    windows = draw.integers(0, 256, (3, byte_conv.WINDOW)).astype(np.uint8)
    got, _ = net.responses(windows)
    for w, row in zip(windows, got):
        want = []
        for width, filters, bias in zip(byte_conv.WIDTHS, net.filters, net.biases):
            for f in range(byte_conv.FILTERS):
                best = max(sum(float(net.embed[w[p + j]] @ filters[j * byte_conv.EMBEDDING : (j + 1) * byte_conv.EMBEDDING, f]) for j in range(width)) for p in range(len(w) - width + 1))
                want.append(max(0.0, best + float(bias[f])))
        assert np.allclose(row, want, atol=1e-4)
    chances = np.exp(net.log_chances(windows))
    assert np.allclose(chances.sum(1), 1, atol=1e-5)


def test_training_lowers_the_loss_of_its_own_windows():
    draw = np.random.default_rng(4)
    labels = np.arange(60) % 3
    windows = np.stack([draw.choice(np.frombuffer(b"abc def ghi"[4 * y : 4 * y + 3] + b" ", np.uint8), byte_conv.WINDOW) for y in labels])
    losses = [-byte_conv.train(windows, labels, ["a", "b", "c"], passes=p).log_chances(windows)[np.arange(60), labels].mean() for p in (1, 20)]
    assert losses[1] < losses[0] and losses[1] < 0.1


def test_expectation_maximisation_equals_one_over_documents():
    draw = np.random.default_rng(5)
    n = len(weak_labels.LABELLERS)
    patterns = np.unique(draw.integers(0, 3, (25, n)), axis=0)
    counts = draw.integers(1, 30, len(patterns)).astype(float)
    rounds = 15
    got, given = weak_labels.fit_votes(patterns, counts, rounds)
    docs = [p for p, c in zip(patterns.tolist(), counts) for _ in range(int(c))]
    truth = []
    for votes in docs:
        said = [sum(votes[i] == weak_labels.JUNK for i in kind) for kind in weak_labels.KINDS]
        clean = 0.1 if sum(said) else 0.98
        weight = [s + 0.01 for s in said]
        truth.append([clean, *[(1 - clean) * w / sum(weight) for w in weight]])
    for _ in range(rounds):
        mass = [sum(t[k] for t in truth) + 1 for k in range(3)]
        share = [[[(sum(t[k] for t, d in zip(truth, docs) if d[i] == v) + 1) / (mass[k] + 2) for v in range(3)] for i in range(n)] for k in range(3)]
        fresh = []
        for votes in docs:
            like = [math.log(mass[k] / sum(mass)) + sum(math.log(share[k][i][votes[i]]) for i in range(n)) for k in range(3)]
            powers = [math.exp(x - max(like)) for x in like]
            fresh.append([1.0, 0.0, 0.0] if weak_labels.JUNK not in votes else [p / sum(powers) for p in powers])
        truth = fresh
    want = {tuple(d): 1 - t[0] for d, t in zip(docs, truth)}
    assert np.allclose(got, [want[tuple(p)] for p in patterns.tolist()], atol=1e-6)
    assert np.allclose(given, share, atol=1e-6)


def test_attention_cost_and_number_of_sequences():
    draw = np.random.default_rng(1)
    counts = {int(n): int(c) for n, c in zip(range(1, 51), draw.integers(1, 40, 50))}
    cost = 3000
    plan = best_fit.pack_lengths(counts, 100, 50, cost)
    loads = defaultdict(list)
    for n, c in counts.items():
        at, _ = plan.places(np.full(c, n), np.arange(c))
        for b in at.tolist():
            loads[b].append(n)
    costs = [sum(n * n for n in held) for held in loads.values()]
    assert max(costs) <= cost and max(costs) > 0.9 * cost
    # two pieces of 50 tokens would fit by tokens alone
    assert all(held.count(50) <= 1 for held in loads.values())
    least = max(math.ceil(sum(n * c for n, c in counts.items()) / 100), math.ceil(sum(n * n * c for n, c in counts.items()) / cost))
    assert least <= len(loads) == plan.bins <= 1.1 * least + 1
