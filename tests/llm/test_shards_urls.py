"""k-d shards and URL templates."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import kd_shards as kd
from ledgerlake.llm import url_templates as ut


def test_shards_are_near_equal_and_keep_copies_together(spark):
    rng = random.Random(2)
    rows = [(i, "x" * rng.randint(0, 300) + str(i), rng.choice(["en", "de", None]), f"s{rng.randint(0, 9)}") for i in range(3000)]
    rows += [(5000 + i, "a copy of three", "en", f"s{i}") for i in range(3)]
    rows += [(9000 + i, "hot" * 40, "en", "s1") for i in range(1500)]  # a third of all rows
    rows += [(20000 + i, "y" * 200, "de", "s2") for i in range(100)]  # fits a shard
    rows += [(1, None, None, None), (None, "", None, None)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, source string, shard int")
    got = kd.shard(docs.repartition(5), 16).collect()
    assert len(got) == len(rows)
    size, slots, copies = {}, {}, {}
    for r in got:
        size[r.shard] = size.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
        copies.setdefault((r.text_crc32, r.size), set()).add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None
    assert set(size) == set(range(16)) and max(size.values()) < 1.06 * min(size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(copies[zlib.crc32(b"a copy of three"), 16]) == len(copies[zlib.crc32(b"y" * 200), 201]) == 1
    want = sorted((r[0] or -1, len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == want


@pytest.mark.parametrize("sf, bound", [("0.001", 1.25), ("0.01", 1.1), ("0.1", 1.03)])
def test_nearly_all_bytes_get_their_shard_from_the_tree(spark, sf, bound):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    got = kd.shard(docs, 16).groupBy("shard").pivot("placed", ["tree", "room", "last"]).sum("size").collect()
    size = [sum(v or 0 for v in (r.tree, r.room, r.last)) for r in got]
    assert len(size) == 16 and sum(r.tree or 0 for r in got) >= 0.9 * sum(size)
    mean = sum(size) / 16
    assert max(size) <= bound * mean and min(size) >= mean / bound, [round(x / mean, 3) for x in size]


def test_tree_equals_a_tree_by_sorting(spark, monkeypatch):
    """Points of equal weight, cut at the median key of the widest dimension."""
    monkeypatch.setattr(kd, "LAST", 0)
    rng = random.Random(6)
    rows = [(i, f"{i:04d}" + "x" * 60, f"l{rng.randint(0, 30)}", f"s{rng.randint(0, 5)}") for i in range(512)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.shard for r in kd.shard(docs, 8).collect()}
    found = docs.select("doc_id", F.xxhash64("text").alias("g"), kd._unit_hash("lang").alias("a"), kd._unit_hash("source").alias("b")).collect()

    def scaled(values):
        lo, hi = min(values), max(values)
        return [(v - lo) / ((hi - lo) or 1.0) for v in values]
    points = list(zip([r.doc_id for r in found], [r.g for r in found], scaled([r.a for r in found]), scaled([r.b for r in found])))

    def cut(group, shards):
        if len(shards) == 1:
            return {p[0]: shards[0] for p in group}
        wide = max((2, 3), key=lambda j: (max(p[j] for p in group) - min(p[j] for p in group)))
        group = sorted(group, key=lambda p: (int(min(p[wide], 0.99999) * 4096), p[1] % (1 << 24)))
        half = len(group) // 2
        return {**cut(group[:half], shards[:len(shards) // 2]), **cut(group[half:], shards[len(shards) // 2:])}
    assert got == cut(points, list(range(8)))


def test_shards_of_few_rows_and_none(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s"), (2, "b", "en", "s")], "doc_id long, text string, lang string, source string")
    got = kd.shard(docs, 16).collect()
    assert len(got) == 2 and all(0 <= r.shard < 16 and r.slot == 0 for r in got)
    assert kd.shard(docs.limit(0), 16).count() == 0


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:end], rest[end:]
    path = rest[:min([rest.index(c) for c in "?#" if c in rest] or [len(rest)])]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    best = None
    for _, r in RULES:
        name, _, start = r.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start) and len(r) > len(best or ""):
            best = r
    return best


def test_urls_and_rules(spark):
    urls = [None, "", "no scheme", "http://", "http://A.Example.NET/en/x?y#z", "https://example.net/en", "https://net", "https://net/",
            "https://planet/x", "http://x.org/fr/1", "http://org/fr/", "ftp://ÀB.org/fr/1", "http://example.com/de/9.html#a", "http://h?a=/b",
            "http://h#f/x", "http://a/b\nc?d", "x://y://z/de/", "http://example.com/fr/1", "http://example.com/fr/2"]
    pages = spark.createDataFrame([(i, u, "v") for i, u in enumerate(urls)] + [(0, None, "v"), (None, "http://a/b", "v")],
                                  "page_id long, url string, verdict string")
    got = ut.judge(pages, spark.createDataFrame([], "page_id long, good double"), RULES).collect()
    assert len(got) == len(urls) + 2
    verdict = {r: v for v, r in RULES}
    for r in got:
        url = urls[r.page_id] if r.page_id is not None else "http://a/b"
        assert (r.host, r.path) == parse(url) and r.rule == rule(r.host, r.path), url
        assert r.verdict == verdict.get(r.rule, "allow")


def test_templates_part_good_from_bad_branches(spark):
    rows = [(i, f"http://h.com/{'spam' if i % 3 == 0 else ['news', 'blog'][i % 2]}/{i}.html") for i in range(900)]
    labels = [(i, 0.0 if i % 3 == 0 else 1.0) for i in range(0, 900, 2)] + [(0, None), (None, 1.0)]
    got = ut.judge(spark.createDataFrame(rows, "page_id long, url string"),
                   spark.createDataFrame(labels, "page_id long, good double"), []).collect()
    assert {(r.verdict, r.template) for r in got if r.page_id % 3 == 0} == {("block", "/spam/{n}.html")}
    assert {r.verdict for r in got if r.page_id % 3} == {"allow"}
    # the two good branches do not differ: what is alike is one template
    assert len({r.template for r in got if r.page_id % 3}) <= 2


def brute_tree(shapes):
    """The tree by plain recursion: {(host, shape): (template, purity)}."""
    out = {}
    n, g = sum(x[3] for x in shapes), sum(x[4] for x in shapes)

    def purity(rows, up):
        return (sum(r[4] for r in rows) + ut.SMOOTH * up) / (sum(r[3] for r in rows) + ut.SMOOTH)

    def grow(rows, level, template, up):
        children = {}
        for r in rows:
            if len(r[1]) <= level:
                out[r[0], r[1]] = (template, up)
            else:
                children.setdefault(r[1][level], []).append(r)
        total = [sum(r[i] for c in children.values() for r in c) for i in (2, 3, 4)]
        branches = {}
        for seg, c in children.items():
            pages, m, good = (sum(r[i] for r in c) for i in (2, 3, 4))
            differs = False
            if m and total[1] - m:
                p = total[2] / total[1]
                error = (p * (1 - p) * (1 / m + 1 / (total[1] - m))) ** 0.5
                gap = abs(good / m - (total[2] - good) / (total[1] - m))
                differs = error > 0 and gap / error >= ut.DIFFERENT
            rare = pages < ut.RARE and pages < ut.RARE_SHARE * total[0]
            keep = pages == total[0] or (not rare and differs)
            branches.setdefault(seg if keep else "*", []).extend(c)
        for branch, c in branches.items():
            grow(c, level + 1, f"{template}/{branch}", purity(c, up))
    for host in {x[0] for x in shapes}:
        mine = [x for x in shapes if x[0] == host]
        grow(mine, 0, "", purity(mine, g / n if n else 1.0))
    return out


def test_tree_equals_plain_recursion(spark):
    rng = random.Random(9)
    shapes = {}
    for _ in range(300):
        host = rng.choice(["a", "b", "c"])
        path = tuple(rng.choice("xyz") + str(i) for i in range(rng.randint(1, 12))) if rng.random() < 0.5 else tuple(
            ["deep"] * 8 + [rng.choice(["good", "bad", "ugly"])] + ["{n}"] * rng.randint(0, 3))
        pages = rng.randint(1, 60)
        labelled = rng.choice([0, rng.randint(0, pages)])
        share = 0.05 if "bad" in path or "x1" in path else 0.9
        shapes[host, path] = (host, path, pages, labelled, float(sum(rng.random() < share for _ in range(labelled))))
    rows = list(shapes.values())
    df = spark.createDataFrame([(h, list(p), n, m, g) for h, p, n, m, g in rows],
                               "host string, shape array<string>, pages long, labelled long, good double")
    got = {(r.host, tuple(r.shape)): (r.template, round(r.purity, 9)) for r in ut.templates(df).collect()}
    assert got == {k: (t, round(p, 9)) for k, (t, p) in brute_tree(rows).items()}


def test_branches_that_part_late_are_parted_and_no_pages_give_none(spark):
    deep = "/".join("abcdefg")
    rows = [(i, f"http://h.com/{deep}/{'spam' if i % 2 else 'news'}/{i}") for i in range(400)] + [(1000, "http://h.com/" + "q/" * 300 + "z" * 5000)]
    labels = [(i, 0.0 if i % 2 else 1.0) for i in range(400)]
    labels = spark.createDataFrame(labels, "page_id long, good double")
    got = {r.page_id: r for r in ut.judge(spark.createDataFrame(rows, "page_id long, url string"), labels, []).collect()}
    assert len(got) == 401 and all(got[i].verdict == ("block" if i % 2 else "allow") for i in range(400))
    assert got[1000].template.count("/") == 301 and got[1000].template.endswith("/q" * 280 + "/" + "z" * 5000)
    assert ut.judge(spark.createDataFrame([], "page_id long, url string"), labels, RULES).count() == 0
