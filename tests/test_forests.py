"""Forests as node tables and random cut trees."""
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from mendstream.operators import detectors as D, forests as FO
from mendstream.operators.templates import WILD, TemplateIndex


def points(n, d, seed, grid=6):
    return np.random.default_rng(seed).integers(0, grid, (n, d)).astype(float)


def plain_displacement(tree, key):
    """From the cuts alone: which points share the key's side of every cut above it."""
    held = {k: tree.nodes[leaf][5][0] for k, leaf in tree.leaf_of.items()}
    at, inside, worst = tree.root, dict(held), 0.0
    while tree.nodes[at][3] >= 0:
        _, low, high, feature, cut, _, _ = tree.nodes[at]
        sides = [{k: p for k, p in inside.items() if (p[feature] <= cut) == left} for left in (True, False)]
        own, other = sides if key in sides[0] else sides[::-1]
        assert own and other
        worst = max(worst, len(other) / len(own))
        inside, at = own, low if key in sides[0] else high
    assert {tuple(p) for p in inside.values()} == {tuple(held[key])}
    return worst


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 14), st.integers(1, 3))
def test_cut_tree_keeps_sizes_boxes_and_displacements(seed, n, d):
    x = points(n, d, seed, 4)
    rng = np.random.default_rng(seed)
    tree = FO.CutTree(rng)
    held = set()
    for step in range(3 * n):
        i = int(rng.integers(0, n))
        if i in held:
            tree.forget(i)
            held.discard(i)
        else:
            tree.insert(i, x[i])
            held.add(i)
        assert set(tree.leaf_of) == held
        for k in held:
            assert tree.displacement(k) == plain_displacement(tree, k)
        for node in tree.nodes.values():
            if node[3] >= 0:
                kids = [tree.nodes[c] for c in node[1:3]]
                assert node[6] == sum(c[6] for c in kids)
                assert (node[5][0] == np.minimum(kids[0][5][0], kids[1][5][0])).all() and (node[5][1] == np.maximum(kids[0][5][1], kids[1][5][1])).all()
    if not held:
        assert tree.root is None and not tree.nodes


def test_grown_at_once_is_like_joining_one_by_one():
    x = np.vstack([np.random.default_rng(0).normal(0, 1, (30, 2)), [[9.0, 9.0]]])
    one = np.zeros(31)
    for s in range(300):
        tree = FO.CutTree(np.random.default_rng(s))
        for i in range(31):
            tree.insert(i, x[i])
        one += [tree.displacement(i) for i in range(31)]
    many = FO.displacements(np.tile(x, (300, 1)), np.repeat(np.arange(300), 31), np.random.default_rng(1)).reshape(300, 31).sum(axis=0)
    assert one.argmax() == many.argmax() == 30
    assert np.abs(one / 300 - many / 300).max() < 0.15 * one.max() / 300


def test_equal_points_are_never_displaced():
    assert (FO.displacements(np.ones((20, 3)), np.zeros(20, int), np.random.default_rng(0)) == 0).all()


def test_grown_nodes_split_every_row_to_its_leaf():
    x = points(200, 4, 3)
    nodes = FO.grow_trees(np.tile(x, (3, 1)), np.repeat([4, 7, 9], 200), np.random.default_rng(0), 6)
    for t in (4, 7, 9):
        here = nodes["tree"] == t
        slot = dict(zip(nodes["node"][here].tolist(), np.flatnonzero(here).tolist()))
        root = next(i for i in slot.values() if nodes["depth"][i] == 0)
        count = {}
        for row in x:
            i = root
            while nodes["feature"][i] >= 0:
                i = slot[int(nodes["low"][i] if row[nodes["feature"][i]] < nodes["cut"][i] else nodes["high"][i])]
            count[i] = count.get(i, 0) + 1
        leaves = {i: int(nodes["size"][i]) for i in slot.values() if nodes["feature"][i] < 0}
        assert count == leaves and nodes["depth"][here].max() <= 6 and nodes["size"][root] == 200


def plain_modes(x, hazard):
    """Run lengths with all matrices kept and inverted anew."""
    from math import lgamma, log, pi

    n, d = x.shape
    runs, logs, modes = [x[:0]], np.zeros(1), []
    for t in range(n):
        modes.append(int(np.argmax(logs)))
        p = []
        for r in runs:
            k, m, v, s = 1.0, np.zeros(d), d + 1.0, np.eye(d)
            for y in r:
                s = s + k / (k + 1) * np.outer(y - m, y - m)
                m, k, v = (k * m + y) / (k + 1), k + 1, v + 1
            f = v - d + 1
            scale = s * (k + 1) / (k * f)
            z = x[t] - m
            p.append(lgamma((f + d) / 2) - lgamma(f / 2) - d / 2 * log(f * pi) - 0.5 * np.linalg.slogdet(scale)[1] - (f + d) / 2 * np.log1p(z @ np.linalg.inv(scale) @ z / f))
        grown = logs + p
        logs = np.concatenate([[np.logaddexp.reduce(grown) - log(hazard)], grown + np.log1p(-1 / hazard)])
        logs -= np.logaddexp.reduce(logs)
        runs = [x[:0], *[np.vstack([r, x[t : t + 1]]) for r in runs]]
    return np.array(modes)


@pytest.mark.parametrize("d", [1, 3])
def test_run_lengths_equal_the_plain_recursion(d):
    rng = np.random.default_rng(d)
    x = np.concatenate([rng.normal(0, 0.1, (25, d)), rng.normal(2, 0.1, (25, d))])
    assert (D.run_length_modes(x, 50) == plain_modes(x, 50)).all()


def test_ten_thousand_rows_of_many_series_stay_in_bounds():
    x = np.concatenate([np.random.default_rng(0).normal(m, 0.05, (700, 8)) for m in range(3)])
    flags = D.change_points(D.run_length_modes(x, 50))
    assert flags[690:720].any() and flags[1390:1420].any()


def linear(templates, tokens, similarity):
    best, at = (-1.0, -1), None
    for k, tpl in enumerate(templates):
        key = (sum(a == b for a, b in zip(tpl, tokens) if a != WILD) / max(len(tokens), 1), sum(a == WILD for a in tpl))
        if key > best:
            best, at = key, k
    if at is None or best[0] < similarity:
        templates.append(list(tokens))
        return templates[-1]
    templates[at][:] = [a if a == b else WILD for a, b in zip(templates[at], tokens)]
    return templates[at]


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 6).flatmap(lambda n: st.lists(st.lists(st.sampled_from("abcd"), min_size=n, max_size=n), max_size=40)), st.sampled_from([0.0, 0.3, 0.4, 0.5, 1.0]))
def test_template_index_equals_the_linear_scan(messages, similarity):
    index, plain = TemplateIndex(similarity), []
    for m in messages:
        assert index.add(m) == linear(plain, m, similarity)
    assert index.templates == plain


def test_a_leaf_of_many_templates_is_fast():
    import time

    rng = np.random.default_rng(0)
    index, start = TemplateIndex(0.4), time.perf_counter()
    for i in range(30000):
        index.add([f"w{k}" for k in rng.integers(0, 10**6, 8)])
    assert time.perf_counter() - start < 20 and len(index.templates) > 25000
