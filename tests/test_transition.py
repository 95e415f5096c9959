"""The transition rules, as tables, and random fork histories."""

import random

import pytest

from forktide.operators import transition as t
from forktide.operators.transition import ChainState, Header, plan_transition


def chain(*names):
    """Headers from 'height' or 'height:branch' names, each on the one before; the first stands on 'root'."""
    out = []
    for n in names:
        out.append(Header(n, out[-1].block_hash if out else "root", int(n.split(":")[0])))
    return out


def state(headers, finalized=None):
    return ChainState({h.height: h for h in headers}, headers[-1] if headers else None, finalized)


def fork(base, *names):
    out = [base]
    for n in names:
        out.append(Header(n, out[-1].block_hash, out[-1].height + 1))
    return out[1:]


def plan(s, head, known=(), depth=2048):
    return plan_transition(s, head, {h.block_hash: h for h in known}.get, depth)


def heights(batch, kind):
    return [e.header.block_hash for e in batch.events if e.kind == kind]


BASE = chain(*map(str, range(7)))


def test_bootstrap_extend_duplicate():
    g = chain("0")[0]
    assert plan(state([]), g).label == "bootstrap"
    with pytest.raises(t.MissingParent):
        plan(state([]), Header("5", "4", 5))
    assert plan(state(BASE[:2]), BASE[2]).label == "extend"
    assert plan(state(BASE[:3]), BASE[2]) == t.Batch("duplicate", BASE[2])
    with pytest.raises(t.InvalidHeight):
        plan(state(BASE[:2]), Header("x", "1", 5))


def test_gap():
    b = plan(state(BASE[:2]), BASE[3], BASE)
    assert (b.label, b.ancestor, heights(b, "apply"), heights(b, "rollback")) == ("gap", BASE[1], ["2", "3"], [])


@pytest.mark.parametrize("depth", range(1, 7))
def test_reorg_of_each_depth(depth):
    new = fork(BASE[6 - depth], *(f"{7 - depth + i}:n" for i in range(depth)))
    b = plan(state(BASE), new[-1], new)
    assert b.label == "reorg" and b.ancestor == BASE[6 - depth] and b.depth == depth
    assert heights(b, "rollback") == [h.block_hash for h in reversed(BASE[7 - depth :])]
    assert heights(b, "apply") == [h.block_hash for h in new]


def test_a_lower_head_on_another_branch_rolls_back_to_it():
    new = fork(BASE[2], "3:n")
    b = plan(state(BASE[:6]), new[0], new)
    assert heights(b, "rollback") == ["5", "4", "3"] and heights(b, "apply") == ["3:n"]


def test_a_canonical_ancestor_as_head_leaves_it_as_checkpoint():
    s = state(BASE)
    b = plan(s, BASE[4])
    assert heights(b, "rollback") == ["6", "5"] and not heights(b, "apply") and b.checkpoint == BASE[4]
    s.commit(b)
    assert s.tip == BASE[4]


def test_bounds_and_finality_leave_the_state_alone():
    new = fork(BASE[4], "5:n", "6:n")
    s = state(BASE)
    assert plan(s, new[-1], new, depth=2).label == "reorg"
    with pytest.raises(t.DepthExceeded):
        plan(s, new[-1], new, depth=1)
    assert plan(state(BASE, finalized=4), new[-1], new).label == "reorg"
    with pytest.raises(t.CrossesFinalized):
        plan(state(BASE, finalized=5), new[-1], new)
    with pytest.raises(t.MissingParent):
        plan(s, new[-1], new[1:])
    assert s == state(BASE)


@pytest.mark.parametrize("seed", range(32))
def test_random_histories_end_on_the_winning_branch(seed):
    rnd = random.Random(seed)
    known = {"0": Header("0", "root", 0)}
    s = state([])
    s.commit(plan(s, known["0"]))
    for i in range(40):
        base = rnd.choice(list(known.values()))
        for j in range(rnd.randint(1, 4)):
            base = Header(f"{i}.{j}", base.block_hash, base.height + 1)
            known[base.block_hash] = base
        before = dict(s.canonical)
        b = plan_transition(s, base, known.get)
        s.commit(b)
        path, at = [], base
        while at:
            path.append(at)
            at = known.get(at.parent_hash)
        assert s.tip == base and s.canonical == {h.height: h for h in path}
        back = [e.header for e in b.events if e.kind == "rollback"]
        assert back == sorted((h for h in before.values() if s.canonical.get(h.height) != h), key=lambda h: -h.height)


def test_the_recursive_plan_agrees(spark):
    new = fork(BASE[3], "4:n", "5:n", "6:n", "7:n")
    rows = [(h.block_hash, h.parent_hash, h.height, h in BASE) for h in [*BASE, *new]]
    blocks = spark.createDataFrame(rows, "block_hash string, parent_hash string, height long, is_canonical boolean")
    got = [(r["event_kind"], r["block_hash"]) for r in t.reorg_plan(spark, blocks, "7:n", 6).orderBy("seq").collect()]
    s = t.state_of(blocks, 6)
    assert got == [(e.kind, e.header.block_hash) for e in plan_transition(s, new[-1], t.stored_resolver(blocks)).events]
