import random
import re

import xxhash

from spokewise.llm import simhash_bktree as sb
from spokewise.llm.components import connected_components
from spokewise.llm.queries import op6_simhash
from tests.llm.edge import ROWS, edge_docs

SF = "/root/testdata/sf0.001"


def fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in runs]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def groups(values, near):
    root = list(range(len(values)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if near(a, values[j]):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return [top(i) for i in range(len(values))]


def close(a, b):
    return (a ^ b).bit_count() <= 2


def expected(rows):
    fps = [fingerprint(t) for _, t in rows]
    top = groups(fps, close)
    low = {}
    for (i, _), g in zip(rows, top):
        if i is not None:
            low[g] = min(low.get(g, i), i)
    return sorted(str((i, f"{f:016x}", low.get(g))) for (i, _), f, g in zip(rows, fps, top))


def run(docs):
    out = sb.components(docs).select("doc_id", sb.hex_fingerprint().alias("fingerprint"), "component_id")
    return sorted(str(tuple(r)) for r in out.collect())


def test_edge_rows(spark):
    assert run(edge_docs(spark)) == expected(ROWS)


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(str(tuple(r)) for r in op6_simhash(spark, SF).collect()) == expected(rows)


def test_links_with_and_without_second_deal(spark):
    random.seed(3)
    values = set()
    for _ in range(25):
        b = random.getrandbits(64)
        for _ in range(25):
            values.add(b ^ 1 << random.randrange(64) ^ 1 << random.randrange(64) ^ 1 << random.randrange(20))
    values = sorted(values)
    df = spark.createDataFrame([(sb._signed(v),) for v in values], "fp long")
    want = {}
    for v, g in zip(values, groups(values, close)):
        want.setdefault(g, set()).add(v)
    for split in (4096, 3):
        comp = connected_components(sb.fingerprint_links(df, 2, split)).collect()
        root = {r.node & (1 << 64) - 1: r.component for r in comp}
        got = {}
        for v in values:
            got.setdefault(root.get(v, ("alone", v)), set()).add(v)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_bk_tree_finds_all_within_radius():
    random.seed(1)
    tree, seen = sb.BKTree(2), []
    for _ in range(800):
        v = random.getrandbits(12)
        assert sorted(tree.add(v)) == [k for k, x in enumerate(seen) if (x ^ v).bit_count() <= 2]
        seen.append(v)


def test_components_of_chain_star_and_empty(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    edges = spark.createDataFrame([*chain, *star, *chain[:5], (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 1050), 1000)}
    assert connected_components(edges.limit(0)).collect() == []


def test_keep_first_and_empty_table(spark):
    docs = edge_docs(spark)
    kept = sb.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 1 in ids and 2 not in ids and ids.count(9) == 1 and ids.count(None) == 2
    assert sb.components(edge_docs(spark, [])).collect() == []


def test_keep_first_tells_texts_with_one_id_apart(spark):
    """Two different texts with an id are two documents; a copy of another document goes, whatever text its id also has."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(1, a), (5, b), (5, c), (7, a), (7, c + " tail"), (7, "wholly different words stand here"), (7, a)]
    want = [(1, a), (5, b), (5, c), (7, c + " tail"), (7, "wholly different words stand here")]
    if bin(sb.fingerprint(c) ^ sb.fingerprint(c + " tail")).count("1") <= 2:
        want.remove((7, c + " tail"))
    for data in (rows, rows[::-1]):
        assert sorted((r.doc_id, r.text) for r in sb.keep_first(edge_docs(spark, data)).collect()) == sorted(want)
