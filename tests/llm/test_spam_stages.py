"""What weak labels, trees and hosts each decide."""

import numpy as np

from corpusloom.llm import pages, spam


def _features(**given):
    f = [0.0] * len(spam.NAMES)
    f[spam._F["vowels"]] = 0.4
    for k, v in given.items():
        f[spam._F[k]] = v
    return f


def test_labels_abstain_where_signs_are_mixed():
    assert spam.weak_label(_features(tags=0.9), False) == 1
    assert spam.weak_label(_features(prose=0.95, distinct=0.7), False) == 0
    assert spam.weak_label(_features(prose=0.5, top_pair=0.1, distinct=0.5), False) == -1
    assert spam.weak_label(_features(prose=0.95, commerce=0.3, distinct=0.3), False) == 1
    assert spam.weak_label(_features(urls=0.9, numbered=0.9), False) == -1  # an ordered list of addresses


def _given():
    """One tree that says 0.02, 0.58 or 0.95 by the first feature."""
    out = spam.BaggedTrees(trees=1)
    out.forest = [[(0, 0.3, 1, 2, 0.5), (-1, 0.0, -1, -1, 0.02), (0, 0.8, 3, 4, 0.5), (-1, 0.0, -1, -1, 0.58), (-1, 0.0, -1, -1, 0.95)]]
    return out


def test_hosts_decide_what_the_trees_leave_open(spark):
    rows = []
    for i in range(200):
        rows.append((i, "fair.example", False, _features(distinct=0.02)))
        rows.append((1000 + i, "bait.example", False, _features(distinct=0.95 if i % 2 else 0.05)))
    rows += [(5000, "fair.example", False, _features(distinct=0.58)), (5001, "bait.example", False, _features(distinct=0.58)), (5002, "new.example", False, _features(distinct=0.58))]
    prof = spark.createDataFrame(rows, "seq long, host string, dead boolean, features array<double>")
    found = {r.seq for r in pages.with_spam(prof, _given()).where("spam").collect()}
    alone = {r.seq for r in pages.with_spam(prof, _given(), host_weight=0.0).where("spam").collect()}
    assert 5001 in found and not {5000, 5002} & found and not {5000, 5001, 5002} & alone


def test_trees_find_what_no_label_covers(spark, small):
    """Over a table with labels of both kinds the trees give verdicts on pages that the labels leave out."""
    d = small.replace("sf0.001", "sf0.1")
    prof = pages.profile(pages.pages(spark, d), pages.words_of(spark, d), frozenset({"dead", "spam"}))
    prof = prof.where("not dead").cache()
    labelled = {r.seq for r in prof.where("label = 1").select("seq").collect()}
    found = {r.seq for r in pages.with_spam(prof).where("spam").select("seq").collect()}
    unlabelled = prof.where("label = -1").count()
    prof.unpersist()
    assert unlabelled > 0.05 * 12_000 and len(found - labelled) > 20
    assert len(found & labelled) > 0.95 * len(labelled)


def test_a_fitted_forest_comes_back_from_text():
    rng = np.random.default_rng(1)
    x = rng.random((300, len(spam.NAMES)))
    y = (x[:, 3] > 0.5).astype(float)
    forest = spam.BaggedTrees().fit(x, y)
    assert (spam.BaggedTrees.loads(forest.dumps()).predict(x) == forest.predict(x)).all() and ((forest.predict(x) > 0.5) == (y > 0.5)).mean() > 0.95
