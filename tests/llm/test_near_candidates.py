"""What the n-gram join searches: candidate components stay small, and lists that most sets are on are not read."""

import random

import numpy as np
from pyspark.sql import functions as F

from daygrid.llm import ngram_join

from . import brute


def test_families_that_share_phrases_are_searched_apart(session, monkeypatch):
    """Phrases that several families hold, but no 500 rows often, do not chain the families to one component."""
    staged, store = {}, ngram_join.stage
    monkeypatch.setattr(ngram_join, "stage", lambda df, name: staged.setdefault(name, store(df, name)))
    pick = random.Random(5)
    phrases = [" ".join(f"p{i}x{k}" for k in range(6)) for i in range(60)]
    rows = []
    for family in range(40):
        parts = [" ".join(f"f{family}x{i}x{k}" for k in range(8)) + " " + phrase for i, phrase in enumerate(pick.sample(phrases, 12))]
        for copy in range(3):
            words = " ".join(parts).split()
            words[pick.randrange(len(words))] = f"own{family}x{copy}"
            rows.append((10 * family + copy, " ".join(words)))
    docs = session.createDataFrame(rows, "doc_id long, text string").repartition(60)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.near_groups(docs).collect()}
    assert found == brute.near_groups(dict(rows))
    assert staged["ngram-components"].groupBy("component").count().agg(F.max("count")).first()[0] <= 3


def test_lists_that_most_sets_are_on_are_turned_round(monkeypatch):
    """Sets that differ from one another in few shingles cost little more than these: the shared ones are not read."""
    read, tally = [], ngram_join._tally
    monkeypatch.setattr(ngram_join, "_tally", lambda tokens, begin, *more: read.append((begin[tokens + 1] - begin[tokens]).sum()) or tally(tokens, begin, *more))
    rng = np.random.default_rng(3)
    base, sets = np.arange(400), []
    for _ in range(200):
        own = base.copy()
        own[rng.choice(400, rng.integers(1, 60), replace=False)] = rng.integers(400, 3000)
        sets.append(np.unique(own[rng.random(400) > 0.02]).astype(np.uint64))
    degree, plain = [0] * 200, [set(s.tolist()) for s in sets]
    for i in range(200):
        for j in range(i):
            if 100 * len(plain[i] & plain[j]) >= 75 * len(plain[i] | plain[j]):
                degree[i] += 1
                degree[j] += 1
    _, found = ngram_join.divide_skip(sets, np.arange(200), whole=(0,))
    assert found.tolist() == degree
    assert sum(read) < 0.1 * 200 * sum(map(len, sets))
