from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import SparkSession

from stockflow.llm import similar as S
from tests.llm import brute


def groups(rows):
    """The group of each row by all pairs, named by its first row."""
    sets = [set(brute.shingles(text, 5)) for _, text in rows]
    near = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])
    ]
    return brute.components(len(rows), near), near


def test_an_empty_table_has_no_rows(docs):
    assert S.similar_groups(docs([])).collect() == []
    assert S.keep_one(docs([])).collect() == []


def test_one_of_each_group_stays_with_its_columns(docs):
    text = " ".join(f"w{k}" for k in range(200))
    rows = [(3, text), (1, text), (2, text.replace("w100", "x")), (9, "other words stand here alone"), (None, text)]
    table = docs(rows)
    kept = S.keep_one(table)
    assert kept.columns == table.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect()) == [(False, 1), (False, 9)]


def test_near_copies_are_found_and_others_left(llm):
    rng = np.random.default_rng(5)
    rows, pairs = [], 0
    for group in range(60):
        parts = [f"w{int(k)}" for k in rng.integers(0, 5000, 300)]
        rows.append((2 * group, " ".join(parts)))
        for at in rng.choice(300, 3, replace=False):
            parts[at] = "changed"
        rows.append((2 * group + 1, " ".join(parts)))
        pairs += 1
    table = llm.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r["doc_id"] for r in S.keep_one(table).collect()}
    assert {2 * g for g in range(60)} <= kept
    assert len(kept) <= 60 + 6


def test_groups_match_brute_force_around_the_threshold(llm, monkeypatch):
    monkeypatch.setattr(S, "FREQUENT_ROWS", 2)
    rng = np.random.default_rng(8)
    texts = []
    for k in range(150):
        parts = [f"w{int(v)}" for v in rng.integers(0, 5000, int(rng.integers(40, 200)))]
        texts.append(parts)
        other = list(parts)
        if k % 3 == 0:
            for at in rng.choice(len(parts), max(1, len(parts) // 45 + k % 2), replace=False):
                other[at] = f"x{k}"
        elif k % 3 == 1:
            other += [f"y{k}w{j}" for j in range(len(parts) // 4 + k % 5 - 2)]
        else:
            other = other[int(len(parts) * 0.2) + k % 5 - 2 :]
        texts.append(other)
    line = "one line that a great many of the pages have at their end".split()
    texts += [[f"z{k}w{j}" for j in range(30)] + line for k in range(60)]
    rows = [(k, " ".join(parts)) for k, parts in enumerate(texts)]
    want, near = groups(rows)
    assert 40 < len(near) < 140
    table = llm.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {r["id"]: r["component"] for r in S.similar_groups(table).collect()}
    assert [found[k] for k in range(len(rows))] == want


def test_rows_are_told_apart_by_id_and_text(docs):
    text = " ".join(f"w{k}" for k in range(50))
    rows = [(1, text), (1, text), (1, "something else"), (2, text), (None, "left alone"), (None, "left alone"),
            (5, None), (6, ""), (None, " "), (7, "other"), (7, "other")]
    kept = S.keep_one(docs(rows)).select("doc_id", "text").collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(
        map(str, [(1, text), (1, "something else"), (None, "left alone"), (5, None), (7, "other")])
    )


@pytest.mark.parametrize("slice_rows", [4, 4096])
def test_hot_shingles_are_cut_without_losing_a_link(llm, monkeypatch, slice_rows):
    monkeypatch.setattr(S, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(S, "RUN_ROWS", slice_rows // 4)
    monkeypatch.setattr(S, "FREQUENT_ROWS", 2)
    rng = np.random.default_rng(4)
    shared = [f"s{k}" for k in range(60)]
    rows = []
    for k in range(90):  # a passage that most texts consist of, some alike and some not
        own = [f"o{k % 30}w{j}" for j in range(int(rng.integers(4, 30)))]
        rows.append((k, " ".join(shared + own)))
    want, near = groups(rows)
    found = {r["id"]: r["component"] for r in S.similar_groups(llm.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    assert [found[k] for k in range(len(rows))] == want and len(set(want)) > 1 and len(near) > 100


def test_a_large_group_of_copies_makes_few_pairs(llm):
    words = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join([*words[: k % 100], f"x{k}", *words[k % 100 + 1 :]])) for k in range(1500)]
    table = llm.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    pairs = []
    whole = S._verified

    def counted(texts, found):
        pairs.append(found.count())
        return whole(texts, found)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(S, "_verified", counted)
        found = S.similar_groups(table).collect()
    assert {r["component"] for r in found} == {0}
    assert sum(pairs) < 30 * len(rows)


def test_sketches_never_differ_more_than_the_sets():
    rng = np.random.default_rng(3)
    for size in (1, 5, 60, 400, 3000):
        for change in (0, 1, 7, size // 4, size):
            left = rng.integers(0, 2**64, size, dtype=np.uint64)
            right = np.unique(np.r_[left[change:], rng.integers(0, 2**64, change // 2, dtype=np.uint64)])
            bits = np.bitwise_count((S._odd(np.unique(left)) ^ S._odd(right)).view(np.uint64)).sum()
            assert bits <= len(np.setxor1d(left, right))
    assert bits > 20


def test_unlike_texts_of_300_words_are_not_proposed(llm, monkeypatch):
    """Texts that share an early shingle, but far fewer than similar ones, meet no join."""
    rng = np.random.default_rng(3)
    base = [f"w{int(v)}" for v in rng.integers(0, 5000, 300)]
    rows = []
    for k in range(20):
        parts = list(base)
        for at in rng.choice(300, 8, replace=False):
            parts[at] = f"text{k}"
        rows.append((k, " ".join(parts)))
    assert len(set(groups(rows)[0])) == 20
    proposed, possible = [], S._possible

    def noting(pairs, vertices):
        proposed.append(pairs.count())
        return possible(pairs, vertices)

    monkeypatch.setattr(S, "_possible", noting)
    found = S.similar_groups(llm.createDataFrame(rows, "doc_id bigint, text string"))
    assert len({r["component"] for r in found.collect()}) == 20
    assert proposed[-1] <= 10


def _searched(monkeypatch):
    """The rows that each search makes, in a list that grows with every round."""
    made, sharing = [], S._sharing

    def noting(every):
        search = sharing(every)
        rows = SparkSession.getActiveSession().sparkContext.accumulator(0)
        made.append(rows)

        def counted(batches):
            for batch in search(batches):
                rows.add(len(batch))
                yield batch

        return counted

    monkeypatch.setattr(S, "_sharing", noting)
    return made


def test_a_loose_group_is_not_compared_pair_by_pair(llm, monkeypatch):
    """Copies of one text with changes of their own; about one pair in three is similar."""
    rng = np.random.default_rng(6)
    base = [f"w{k}" for k in range(250)]
    rows = []
    for k in range(400):
        parts = list(base)
        for at in rng.choice(250, 3, replace=False):
            parts[at] = f"text{k}at{at}"
        rows.append((k, " ".join(parts)))
    made = _searched(monkeypatch)
    table = llm.createDataFrame(rows, "doc_id bigint, text string").repartition(40)
    found = {r["id"]: r["component"] for r in S.similar_groups(table).collect()}
    assert [found[k] for k, _ in rows] == groups(rows)[0]
    assert sum(rows.value for rows in made) < 100 * len(rows)


def test_a_passage_that_few_texts_of_each_batch_share_is_frequent(llm):
    passage = [f"p{k}" for k in range(60)]
    rows = [(k, " ".join([f"t{k}w{j}" for j in range(300)] + passage)) for k in range(40)]
    table = llm.createDataFrame(rows, "doc_id bigint, text string").repartition(20)
    found, times = S._frequent(S._texts(table, "text"))
    shared = set(S.shingle_set(" ".join(passage).encode()).tolist())
    counted = {value for value in shared if value % S.COUNTED == 0}
    assert len(counted) > 5 and counted == set(found.tolist()) & shared
    assert (times == 40).all()
