import re

from tests.llm.rows import documents, edge_rows, prose
from visitlens.llm import similarity
from visitlens.llm.common import Shelf, read
from visitlens.llm.graph import components
from visitlens.llm.similarity import Forest


def shingles(text):
    words = re.findall(r"[^\x20\t-\r]+", text)
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(rows, threshold=0.8):
    """(doc_id, class_id, n_links) of every row by comparing all pairs."""
    sets = [shingles(text or "") for _, text in rows]
    forest, links = Forest(len(rows)), [0] * len(rows)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            same = (rows[i][1] or "") == (rows[j][1] or "")
            if i != j and (same or a and b and len(a & b) >= threshold * len(a | b)):
                links[i] += 1
                forest.join(i, j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        root = forest.root(i)
        least[root] = min(least.get(root, (True, 0)), (doc_id is None, doc_id or 0))
    ids = {root: None if none else value for root, (none, value) in least.items()}
    return sorted(((doc_id, ids[forest.root(i)], links[i]) for i, (doc_id, _) in enumerate(rows)), key=repr)


def near_rows():
    rows = []
    for group in range(12):
        base = prose(group, 150).split() + [f"g{group}w{k}" for k in range(100)]
        for copy in range(1 + group):
            words = list(base)
            for k in range(copy):
                words[150 + 9 * k % 90] = f"c{copy}"
            rows.append((1000 * group + copy, " ".join(words)))
    return rows


def found(spark, rows, **options):
    df = similarity.classes(spark, documents(spark, rows), **options)
    return sorted((tuple(r) for r in df.select("doc_id", "class_id", "n_links").collect()), key=repr)


def test_awkward_rows_equal_brute_force(spark):
    rows = [*edge_rows(), *near_rows()]
    assert found(spark, rows) == plain(rows)


def test_deep_splits_and_block_pairs_lose_no_link(spark):
    rows = near_rows()
    assert found(spark, rows, small=2, block=3, depth=3) == plain(rows)


def test_whole_table_equals_brute_force(spark):
    rows = [tuple(r) for r in read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    got = similarity.op4_chosen_path_join(spark, "/root/testdata/sf0.001")
    assert sorted((tuple(r) for r in got.select("doc_id", "class_id", "n_links").collect()), key=repr) == plain(rows)


def test_one_of_each_class_stays(spark):
    rows = [*edge_rows(), *near_rows()]
    docs = documents(spark, rows)
    kept = similarity.one_of_each(spark, docs)
    assert kept.columns == docs.columns
    got = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert set(got) == {c for _, c, _ in plain(rows)}
    assert len(got) == len(set(got))
    assert similarity.classes(spark, documents(spark, [])).collect() == []


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    edges += [(b, a) for a, b in edges[:10]]
    got = dict(components(spark.createDataFrame(edges, "a long, b long"), Shelf(spark, "test")).collect())
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100), **dict.fromkeys(range(200, 203), 200)}


def test_runs_reach_the_target():
    meet = 1.0
    for _ in range(2):
        meet = 1 - (1 - meet / 128) ** 128
    runs = similarity.runs_needed(0.8, 128, 2, 0.99)
    assert 1 - (1 - meet) ** runs >= 0.99 > 1 - (1 - meet) ** (runs - 1)
