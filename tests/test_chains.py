import datetime as dt
import random

import pytest

from conftest import rows
from tradeledger.operators import chains

RELATION = "source long, target long, relation_type int"


def chain(first, edges):
    return [(first + i, first + i + 1) for i in range(edges)]


def resolve(spark, edges, **kw):
    df = spark.createDataFrame(edges, "source long, target long")
    return {r["source"]: (r["first_target"], r["final_target"], r["hops"]) for r in chains.resolve_chain(df, **kw).collect()}


def loop_model(edges, rounds=10):
    """Round by round on one smallest target per source: hop 1 in the first round, the end one round later."""
    step = {}
    for s, t in edges:
        step[s] = min(t, step.get(s, t))
    out = {}
    for source, target in step.items():
        node, final = None, None
        for _ in range(rounds):
            if node is None:
                node, final = target, None
            elif node in step:
                node, final = step[node], None
            else:
                final = node
        out[source] = final
    return out


@pytest.mark.parametrize("edges", [1, 2, 9, 10, 11, 16, 17, 30])
def test_chains_up_to_nine_edges_are_resolved(spark, edges):
    links = chain(100, edges)
    got = resolve(spark, links)
    assert {s: v[1] for s, v in got.items()} == loop_model(links)
    assert (got[100][1] is not None) == (edges <= 9)
    assert got[100 + edges - 1] == (100 + edges, 100 + edges, 1)


def test_cycles_and_self_loops_stay_unresolved(spark):
    links = [(1, 2), (2, 1), (5, 5), (7, 5), (8, 9)]
    got = resolve(spark, links)
    assert {s: v[1] for s, v in got.items()} == loop_model(links) == {1: None, 2: None, 5: None, 7: None, 8: 9}


@pytest.mark.parametrize("seed", range(4))
def test_random_graphs_follow_the_rounds(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(150), rng.randrange(220)) for _ in range(160)]
    assert {s: v[1] for s, v in resolve(spark, links).items()} == loop_model(links)


def test_the_smallest_of_several_targets_wins(spark):
    assert resolve(spark, [(1, 9), (1, 4), (4, 6)])[1] == (4, 6, 2)


def test_many_sources_of_one_hub(spark):
    got = resolve(spark, [(i, 1000) for i in range(300)] + [(1000, 1001)])
    assert {v for s, v in got.items() if s < 300} == {(1000, 1001, 2)}


@pytest.mark.parametrize("rounds", [2, 3, 5])
def test_round_limit_is_an_argument(spark, rounds):
    links = chain(1, 6)
    assert {s: v[1] for s, v in resolve(spark, links, max_rounds=rounds).items()} == loop_model(links, rounds)


def test_a_final_node_has_no_outgoing_edge(spark):
    links = chain(1, 8) + chain(50, 3) + [(2, 60), (90, 3)]
    sources = {s for s, _ in links}
    assert not sources & {v[1] for v in resolve(spark, links).values()}


def test_first_date_and_count_per_final_node(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (9, 3), (20, 20)], "source long, target long")
    days = spark.createDataFrame([(1, dt.date(2024, 1, 5)), (2, dt.date(2024, 1, 7)), (9, dt.date(2024, 1, 2)), (20, dt.date(2024, 1, 1))], "source long, day date")
    got = rows(chains.chain_first_date(chains.resolve_chain(df), days), "so_number", "first_sale", "adjustments")
    assert got == [(3, dt.date(2024, 1, 2), 3)]


def test_removal_of_adjusted_orders(spark):
    relations = spark.createDataFrame(
        [(1, 2, 6), (2, 3, 6), (10, 11, 5), (20, 21, 8), (30, 31, 4)] + [(s, t, 6) for s, t in chain(100, 10)], RELATION
    )
    resolved = chains.resolve_chain(relations.filter("relation_type = 6"))
    sales = spark.createDataFrame([(n,) for n in (1, 2, 3, 10, 11, 20, 21, 30, 31, 100, 109, 110)], "so_number long")
    dropped = chains.remove_adjusted_orders(sales, relations, resolved)
    assert [r[0] for r in rows(dropped)] == [3, 20, 30, 31, 110]
    kept = chains.remove_adjusted_orders(sales, relations, resolved, keep_unresolved=True)
    assert [r[0] for r in rows(kept)] == [3, 20, 30, 31, 100, 110]
