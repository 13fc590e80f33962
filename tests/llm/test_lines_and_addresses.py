from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketloom.llm import canonical, cooccur, repeated_lines


def naive_template(line: str) -> str:
    return re.sub(r"\d+", "0", re.sub(r"\s+", " ", line.strip().lower()))


def test_repeated_lines_against_a_plain_loop(spark):
    rng = random.Random(3)
    pool = ["Share 12 times", "share  345 TIMES", "© 2024 Site", "By\u00a0A B", "", "   ", "long " * 500] + [f"unique {chr(97 + i)}" for i in range(20)]
    docs = [(i, rng.choice(["s1", "s2", None]), "\n".join(rng.choice(pool) for _ in range(6))) for i in range(60)] + [(90, "s1", None), (91, "s1", "")]
    counts = defaultdict(set)
    for i, s, c in docs:
        for line in (c or "").split("\n"):
            counts[s, naive_template(line)].add(i)
    want = {(i, n) for i, s, c in docs for n, line in enumerate((c or "").split("\n"), 1) if naive_template(line) and len(counts[s, naive_template(line)]) >= 4}
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "id int, source_domain string, content string, template string, leaf int")
    found = repeated_lines.find_repeated_lines(df)
    assert {(r.id, r.line_no) for r in found.collect()} == want
    clean = {r.id: r.clean for r in repeated_lines.without_lines(df, found).collect()}
    for i, _, c in docs:
        assert clean[i] == (None if c is None else "\n".join(x for n, x in enumerate(c.split("\n"), 1) if (i, n) not in want))


def test_repeated_lines_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id int, source_domain string, content string")
    assert repeated_lines.find_repeated_lines(df).count() == 0


def test_templates_of_merged_trees(spark):
    """Leaves are merged over partitions; positions that differ become slots, and the exact test keeps lines of one template apart."""
    docs = [(i, "s", f"read our letter now {'daily' if i % 2 else 'weekly'} on {i}\nmore on {i} to come today\nline of {chr(97 + i)} only") for i in range(8)]
    df = spark.createDataFrame(docs, "id int, source_domain string, content string").repartition(2)
    got = {r.template: (r.slots, r.docs) for r in repeated_lines.templates(df).collect()}
    assert got["more on 0 to come today"] == (0, 8)
    assert got["read our letter now <*> on 0"] == (1, 8)
    assert "line of <*> only" in {r.template for r in repeated_lines.templates(df.coalesce(1), depth=2).collect()}
    assert {r.line_no for r in repeated_lines.find_repeated_lines(df).collect()} == {1, 2}
    assert {r.line_no for r in repeated_lines.find_repeated_lines(df, min_docs=5).collect()} == {2}
    assert [repeated_lines.covering_leaves(repeated_lines.grown(df, depth=d), 4).count() for d in (2, 4)] == [3, 2]


def test_templates_show_every_line_of_their_leaf_in_any_partitioning(spark, monkeypatch):
    """Tasks that see a leaf once, several lines of a leaf in one document, a token that looks like a slot, and leaves joined by a shuffle."""
    docs = [(i, "s" if i % 2 else None, f"read our letter now {'daily' if i < 7 else 'weekly'} on {i}\nread our letter now {'on' if i == 2 else 'by'} monday {i}\nthe end of {chr(97 + i)}\nsee the sign of <*> here") for i in range(8)]
    lines = defaultdict(lambda: (set(), set()))
    for i, s, c in docs:
        for t in (naive_template(x).split(" ") for x in c.split("\n")):
            leaf = lines[s, len(t), *("<*>" if "0" in x else x for x in t[:4])]
            leaf[0].add(i), leaf[1].add(tuple(t))
    met = [(key[0], [x[0] if len(set(x)) == 1 else None for x in zip(*forms)], len(ids)) for key, (ids, forms) in lines.items() if len(ids) >= 4]
    want = sorted(((s or "", " ".join("<*>" if x is None else x for x in t), t.count(None), n) for s, t, n in met))
    assert len(want) == 4 and want[0][1:] == ("read our letter now <*> <*> 0", 2, 4)
    df = spark.createDataFrame(docs, "id int, source_domain string, content string")
    got = lambda x: sorted((r.source or "", r.template, r.slots, r.docs) for r in repeated_lines.templates(x).collect())
    assert got(df.coalesce(1)) == want
    alone = spark.createDataFrame(spark.sparkContext.parallelize(docs, len(docs)), df.schema)
    assert got(alone) == want
    monkeypatch.setattr(repeated_lines, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(repeated_lines, "MAX_LEAVES", 1)
    assert got(alone) == want and got(df.coalesce(1)) == want


def test_equal_lines_in_one_document_count_once(spark):
    df = spark.createDataFrame([(i, "s", "a\na\na\na\na") for i in range(3)], "id int, source_domain string, content string")
    assert repeated_lines.find_repeated_lines(df).count() == 0
    assert repeated_lines.find_repeated_lines(df, min_docs=3).count() == 15


SAME = [
    "https://www.site.example/a/Some-Story-12?id=1&lang=en", "http://site.example//a/some_story_12?lang=en&id=1#top", "<https://site.example/a/some%2Dstory-12?id=1&lang=en>", "SITE.example/a/some story-12/?utm_source=x&id=1&lang=en&q=",
    "https://site.example/a/so%6De-story-12?lang=en&id=1&fbclid=abc&ref=z\t",
]


def test_addresses_that_differ_in_form_only(spark):
    others = ["https://site.example/a/some-story-12?id=2&lang=en", "https://site.example/a/some-story-12?id=1&lang=en&page=2", "https://other.example/a/some-story-12?id=1&lang=en", "https://site.example/a/some-story-1?2id=1&lang=en"]
    rows = [(i, None if i % 2 else u, u if i % 2 else "x") for i, u in enumerate(SAME + others)] + [(50, None, None), (51, " ", None), (52, "\u00a0", "")]
    df = spark.createDataFrame(rows, "id int, url_canonical string, url string")
    assert {(r.id_a, r.id_b) for r in canonical.pairs(df).collect()} == {(a, b) for a in range(5) for b in range(a + 1, 5)}
    groups = {r.id: r.copies for r in canonical.collapse(df).collect()}
    assert groups[0] == 5 and sum(groups.values()) == len(rows) and len(groups) == 1 + len(others) + 3


def test_hot_keys_go_through_two_levels_with_the_same_result(spark):
    rows = [(i, f"http://hot.example/{'' if i % 3 else i}", None) for i in range(300)] + [(7, "http://hot.example/", None)]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "id int, url_canonical string, url string, key string, n int")
    plain, hot = ({(r.id, r.copies) for r in canonical.collapse(df, hot=h).collect()} for h in (10_000, 20))
    assert plain == hot and sum(n for _, n in hot) == 301
    assert {(r.id, r.rep_id) for r in canonical.membership(df).collect()} >= {(7, 1)}


def test_pairs_of_a_hot_key_are_spread_over_tasks(spark):
    rows = [(i, "http://hot.example/" if i % 3 else f"http://cold.example/{i // 6}", None) for i in range(300)] + [(7, "http://hot.example/", None)]
    df = spark.createDataFrame(rows, "id int, url_canonical string, url string")
    want = {(a, b) for a in range(300) for b in range(a + 1, 300) if (a % 3 and b % 3) or (not a % 3 and not b % 3 and a // 6 == b // 6)}
    found = canonical.pairs(df, hot=20).collect()
    assert {(r.id_a, r.id_b) for r in found} == want == {(r.id_a, r.id_b) for r in canonical.pairs(df).collect()} and len(found) == len(want)
    each = [r["count"] for r in canonical.matches(df, hot=20).groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(each) < 0.25 * sum(each)


def test_addresses_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id int, url_canonical string, url string")
    assert canonical.pairs(df).count() == 0 and canonical.collapse(df).count() == 0


@pytest.mark.parametrize("terms", [3, 2_000_000])
def test_pair_counts_against_a_plain_loop(spark, monkeypatch, terms):
    rng = random.Random(1)
    names = [" $aa ", "AA", "bb", "Bb\u00a0", "c", None, "", "$", "d", "e"]
    baskets = [[rng.choice(names) for _ in range(rng.randrange(7))] for _ in range(300)] + [None, [], [None]]
    clean = [{x.replace("\u00a0", " ").strip().lstrip("$").strip().upper() for x in b or [] if x is not None} - {""} for b in baskets]
    want = defaultdict(int)
    for b in clean:
        for x in b:
            for y in b:
                want[x, y] += x <= y
    df = spark.createDataFrame([(b, 1, "z") for b in baskets], "tickers array<string>, n int, item_a string").repartition(3)
    got = {(r.item_a, r.item_b): r.n for r in cooccur.gram(df).collect()}
    assert got.pop((None, None)) == sum(bool(b) for b in clean)
    assert got == {k: n for k, n in want.items() if n}
    lifted = cooccur.lifted_pairs(df, min_count=5, min_lift=1.0).collect()
    for r in lifted:
        assert r.n_ab == want[r.item_a, r.item_b] >= 5 and r.n_ab * r.n_records >= r.n_a * r.n_b


def test_gram_blocks_agree(monkeypatch):
    """Item blocks of any width, down to one entry, give the plain counts; a wide basket among narrow ones too."""
    rng = random.Random(5)
    baskets = [sorted({f"i{rng.randrange(40)}" for _ in range(rng.randrange(9))}) for _ in range(200)] + [[f"i{k}" for k in range(400)]]
    offsets, names = np.cumsum([0, *map(len, baskets)]), pa.array([x for b in baskets for x in b])
    want = defaultdict(int)
    for b in baskets:
        for x in b:
            for y in b:
                want[x, y] += x <= y
    for terms in (1, 50, 2_000_000):
        monkeypatch.setattr(cooccur, "TERMS", terms)
        g = cooccur.GramSums()
        g.add(offsets[:101], names[: offsets[100]])
        g.add(offsets[100:] - offsets[100], names[offsets[100] :])
        got = {(x, y): n for x, y, n in zip(*(c.to_pylist() for c in g.flush().columns))}
        assert got.pop((None, None)) == sum(map(bool, baskets)) and got == {k: n for k, n in want.items() if n}


def test_pair_counts_of_an_empty_table(spark):
    assert cooccur.lifted_pairs(spark.createDataFrame([], "tickers array<string>")).count() == 0
