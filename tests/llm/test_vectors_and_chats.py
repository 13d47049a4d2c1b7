"""NN-descent, components and quotation linking against brute force and worked examples."""

import re

import numpy as np
import pytest

from textpulse.llm import neighbours, quotes
from textpulse.llm.components import connected


def vectors():
    rng = np.random.default_rng(5)
    base = rng.standard_normal((300, 24))
    out = list(base)
    out += [v + 0.05 * rng.standard_normal(24) for v in base[:40]]
    out += [base[1] + 0.02 * rng.standard_normal(24) for _ in range(60)]
    out += [base[2].copy() for _ in range(30)]
    return [[float(x) for x in v] for v in out]


def brute(values, threshold=0.95):
    unit = np.array(values) / np.linalg.norm(values, axis=1, keepdims=True)
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    return near


def test_links_and_components(spark):
    values = vectors()
    odd = [None, [], [0.0] * 24, [None] + [1.0] * 23, [float("nan")] * 24, [float("inf")] * 24, [1.0, 2.0]]
    rows = [(i, v, "clash") for i, v in enumerate(values)] + [(1_000 + i, v, "clash") for i, v in enumerate(odd)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node string").repartition(3)
    got = {r.vec_id: r for r in neighbours.near_duplicates(table).collect()}
    near = brute(values)
    assert len(got) == len(rows)
    found = sum(got[i].n_links for i in range(len(values)))
    assert found >= 0.9 * near.sum() and all(got[i].n_links <= near[i].sum() for i in range(len(values)))
    for i in range(len(values)):
        seen, stack = {i}, [i]
        while stack:
            new = set(np.flatnonzero(near[stack.pop()]).tolist()) - seen
            seen |= new
            stack += new
        if found == near.sum():
            assert got[i].component_id == min(seen) and got[i].kept == (i == min(seen))
    for i in range(len(odd)):
        assert (got[1_000 + i].n_links, got[1_000 + i].component_id, got[1_000 + i].kept) == (0, 1_000 + i, True)
    assert neighbours.near_duplicates(table.limit(0)).count() == 0


def two_groups(size=20, dim=64):
    """Two groups whose members are closer to their own than to the other group, though all are linked."""
    rng = np.random.default_rng(9)
    axis = rng.standard_normal((2, dim))
    axis[0] /= np.linalg.norm(axis[0])
    axis[1] -= (axis[1] @ axis[0]) * axis[0]
    axis[1] /= np.linalg.norm(axis[1])
    turn = np.arccos(0.96)
    centres = [axis[0], np.cos(turn) * axis[0] + np.sin(turn) * axis[1]]
    return [c + 0.005 * rng.standard_normal(dim) for c in centres for _ in range(size)]


def test_links_between_groups_with_full_lists(spark):
    rng = np.random.default_rng(1)
    values = [[float(x) for x in v] for v in [*two_groups(), *rng.standard_normal((100, 64))]]
    near = brute(values)
    assert near[:20, 20:40].sum() > 300
    table = spark.createDataFrame(list(enumerate(values)), "vec_id long, embedding array<double>").repartition(3)
    got = {r.vec_id: r for r in neighbours.near_duplicates(table).collect()}
    assert [got[i].n_links for i in range(len(values))] == near.sum(1).tolist()
    assert {got[i].component_id for i in range(40)} == {0}


def test_an_audit_goes_on_until_it_sees_links(spark):
    rng = np.random.default_rng(2)
    values = list(rng.standard_normal((2_000, 16)))
    values[1_999] = values[0] + 0.001
    unit = [v / np.linalg.norm(v) for v in values]
    nodes = spark.createDataFrame([(i, 16, bytearray(v.tobytes()), 1) for i, v in enumerate(unit)], "node long, dim int, vec binary, weight long")
    near = brute(values).sum(1).tolist()
    for lost, want in ((0, 1.0), (1, 0.0)):
        counts = spark.createDataFrame([(i, 0 if lost else n, False) for i, n in enumerate(near)], "node long, links long, exact boolean")
        assert neighbours.audit(nodes, counts) == (want, sum(n > 0 for n in near))


def test_low_recall_is_returned(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ROUNDS", 1)
    monkeypatch.setattr(neighbours, "audit", lambda *_: (0.5, 7))
    table = spark.createDataFrame([(i, v) for i, v in enumerate(vectors()[:50])], "vec_id long, embedding array<double>")
    got = neighbours.near_duplicates(table).collect()
    assert len(got) == 50 and {(r.recall, r.recall_seen) for r in got} == {(0.5, 7)}


def test_full_lists_are_doubled(spark):
    """Groups of 40 and, in two halves, of 30 outgrow three lengths of lists and fit the last."""
    rng = np.random.default_rng(4)
    values = np.array([*two_groups(15), *(rng.standard_normal(64) + 0.01 * rng.standard_normal((40, 64))), *rng.standard_normal((200, 64))])
    near = brute(values)
    unit = values / np.linalg.norm(values, axis=1, keepdims=True)
    nodes = spark.createDataFrame([(i, i, 64, bytearray(u.tobytes())) for i, u in enumerate(unit)], "node long, root long, dim int, vec binary")
    graph = neighbours.Graph(nodes)
    graph.plant([0, 1, 2, 3])
    graph.refine()
    wide, links, full = neighbours.enlarged(graph, 0.95)
    assert wide.keep == 48 and wide.n == 70 and full.isEmpty()
    got = {(r.a, r.b) for r in links.collect()}
    assert got == {(int(a), int(b)) for a, b in zip(*np.nonzero(near))}


def test_a_third_of_all_rows_in_one_group_and_rare_links(spark):
    rng = np.random.default_rng(8)
    hot = rng.standard_normal(32) + 0.03 * rng.standard_normal((500, 32))
    lone = rng.standard_normal((1_000, 32))
    lone[999] = lone[0] + 0.001
    values = np.vstack([hot, lone])
    near = brute(values)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(values)] + [(None, [float(x) for x in lone[5]])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {r.vec_id: r for r in neighbours.near_duplicates(table).collect()}
    want = near.sum(1)
    want[505] += 1
    assert [got[i].n_links for i in range(1_500)] == want.tolist()
    assert {got[i].component_id for i in range(500)} == {0} and got[1_499].component_id == 500
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (1, 505, False)


def test_trees_grow_with_their_depth():
    assert neighbours.trees_for(1_000) >= neighbours.TREES
    for n in (10**4, 10**6, 10**7):
        bits = np.ceil(np.log2(n / neighbours.LEAF))
        meets = (1 - np.arccos(0.95) / np.pi) ** bits
        assert 1 - (1 - meets) ** neighbours.trees_for(n) >= neighbours.RECALL


def test_component_counts_are_exact_over_tiles(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TILE", 16)
    values = vectors()[300:]
    unit = np.array(values) / np.linalg.norm(values, axis=1, keepdims=True)
    rows = [(0, i, 24, bytearray(u.tobytes()), 1) for i, u in enumerate(unit)]
    members = spark.createDataFrame(rows, "root long, node long, dim int, vec binary, weight long")
    got = {r.node: r.links for r in neighbours.component_links(members).collect()}
    assert [got[i] - 1 for i in range(len(values))] == brute(values).sum(1).tolist()


def test_chains_and_stars_are_one_component(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, n) for n in range(1_000, 1_200)]
    links = spark.createDataFrame([*chain, *star, (5, 5), (101, 100), (9, 8)], "a long, b long")
    got = {r.node: r.component for r in connected(links).collect()}
    want = {n: 100 for n in range(100, 161)} | {n: 7 for n in [7, *range(1_000, 1_200)]} | {8: 8, 9: 8}
    assert got == want
    assert connected(links.limit(0)).count() == 0


CHAT = [
    (1, 0, "user", "How do I sort a list?\n\nIn Python, please."),
    (1, 1, "assistant", "> how do I   sort a list?\nUse sorted()."),
    (1, 2, "user", "Thanks!"),
    (1, 3, "user", ">> How do I sort a list?\n> Use sorted().\n\nIs it stable?"),
    (1, 4, "assistant", "> In Python, please.\nSure."),
    (1, 5, "assistant", "> something nobody said\nHm."),
    (2, 0, "user", "> How do I sort a list?\nOther conversation."),
    (2, 1, None, None),
    (2, 1, None, None),
    (None, 0, "user", "alone"),
    (3, None, "user", "no turn"),
]


def test_quotes_are_linked_and_taken_out(spark):
    table = spark.createDataFrame(
        [(*r, "clash") for r in CHAT], "conv_id long, turn long, role string, text string, parent_turn string"
    ).repartition(3)
    got = quotes.link_quotes(table).collect()
    assert len(got) == len(CHAT)
    first = {r.turn: r for r in got if r.conv_id == 1}
    assert [first[t].parent_turn for t in range(6)] == [None, 0, 1, 1, 0, 4]
    assert [(first[t].quote_depth, first[t].n_quotes, first[t].n_linked) for t in range(6)] == [
        (0, 0, 0), (1, 1, 1), (0, 0, 0), (2, 2, 2), (1, 1, 1), (1, 1, 0)
    ]
    assert [first[t].body for t in (1, 3, 4)] == ["Use sorted().", "Is it stable?", "Sure."]
    assert [r.turn for r in sorted(first.values(), key=lambda r: r.position)] == [0, 1, 4, 2, 3, 5]
    assert first[1].formatted == "<|assistant|>\nUse sorted()."
    other = {(r.conv_id, r.turn): r for r in got}
    assert (other[2, 0].n_quotes, other[2, 0].n_linked) == (1, 0)
    assert sorted(r.position for r in got if r.conv_id == 2) == [0, 1, 2]
    assert (other[3, None].parent_turn, other[3, None].position) == (None, 0)
    assert quotes.link_quotes(table.limit(0)).count() == 0


def plain_links(messages):
    """Brute force over (turn, text): n_linked and the parent that quotations give, per turn."""
    def squeeze(t):
        return " ".join(t.lower().split())

    def parsed(text):
        out, last = [], None
        for raw in (text or "").split("\n"):
            mark = re.match(quotes.MARKS, raw)
            level, line = (mark[0].count(">"), raw[mark.end():]) if mark else (0, raw)
            if not line.strip():
                last = None
                continue
            if last != level:
                out.append((level, []))
            out[-1][1].append(squeeze(line))
            last = level
        return out

    said, result = [], {}
    for turn, text in sorted(messages):
        found = []
        for level, parts in parsed(text):
            if level:
                def latest(wording):
                    return max((t for t, w in said if wording in w and t < turn), default=None)
                lines = [latest(p) for p in parts]
                origin = latest(" ".join(parts))
                if origin is None and None not in lines:
                    origin = min(lines)
                if origin is not None:
                    found.append((-level, origin))
        result[turn] = (len(found), max(found)[1] if found else None)
        own = [parts for level, parts in parsed(text) if not level]
        said.append((turn, {" ".join(p) for p in own} | {x for p in own for x in p} | {" ".join(x for p in own for x in p)}))
    return result


@pytest.mark.parametrize("per_bucket", [3, 50_000])
def test_quotes_link_like_brute_force(spark, monkeypatch, per_bucket):
    """Few different lines, so that most are said and quoted again and again, over one bucket of turns and over many."""
    monkeypatch.setattr(quotes, "ROWS_PER_BUCKET", per_bucket)
    rng = np.random.default_rng(8)
    chats = {
        conv: [
            (turn, "\n".join(
                ["", "> ", "> > "][rng.choice(3, p=[0.5, 0.35, 0.15])] + ["The  answer", "is YES", "not so", ""][rng.integers(4)]
                for _ in range(rng.integers(0, 7))
            ))
            for turn in range(40)
        ]
        for conv in (1, 2)
    }
    rows = [(conv, turn, "user", text) for conv, chat in chats.items() for turn, text in chat]
    got = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        linked, parent = plain_links(chats[r.conv_id])[r.turn]
        assert r.n_linked == linked
        assert r.parent_turn == (parent if parent is not None else r.turn - 1 if r.turn else None)


def test_partial_quotes_latest_origins_and_attributions(spark):
    chat = [
        (0, "The answer is yes."), (1, "One line.\nAnother line.\nA third."), (2, "The answer is yes."),
        (3, "On Monday, A wrote:\n> The answer is yes.\nThanks."), (4, "B writes:\n\n> another  LINE.\n\nGood. She wrote:"),
        (5, "> another line.\n> a third.\nFine."), (6, "> another line.\n> never said.\nWhat?"),
    ]
    table = spark.createDataFrame([(1, t, "user", x) for t, x in chat], "conv_id long, turn long, role string, text string")
    got = {r.turn: r for r in quotes.link_quotes(table).collect()}
    assert [got[t].parent_turn for t in range(7)] == [None, 0, 1, 2, 1, 1, 5]
    assert [got[t].body for t in (3, 4, 5)] == ["Thanks.", "Good. She wrote:", "Fine."]


def test_a_parent_stands_before_its_replies(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    got = quotes.link_quotes(table).toPandas()
    assert len(got) == table.count()
    place = {(r.conv_id, r.turn): r.position for r in got.itertuples()}
    assert all(place[r.conv_id, r.parent_turn] < r.position for r in got.itertuples() if r.parent_turn == r.parent_turn)


def test_units_and_odd_vectors():
    import pandas as pd

    unit = neighbours._unit(pd.Series([[3.0, 4.0], None, [0.0], [1e300, 1e300]]))
    assert np.frombuffer(unit[0]).tolist() == pytest.approx([0.6, 0.8]) and unit[1] is None and unit[2] is None
    assert np.frombuffer(unit[3]).tolist() == pytest.approx([0.5**0.5] * 2)
