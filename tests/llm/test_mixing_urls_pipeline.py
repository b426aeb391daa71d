"""Source mixing, URL filtering and the pipeline's stages."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ratesmith.llm import mixing, urls
from ratesmith.llm.queries import QUERIES, URL_RULES
from ratesmith.session import scratch_path

from .conftest import SCHEMA, SF001, rows


def fill(sizes, weights=(1, 2, 3), most=3):
    """Targets by sharing and resharing until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = dict.fromkeys(order, 0.0), set(order), float(sum(sizes.values()))
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] > most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                open_.discard(s)
    return target


def check_mix(docs, **options):
    got = mixing.mix(docs, **options).collect()
    plain = docs.collect()
    assert len(got) == len(plain)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(r.doc_id), count(r.text)) for r in plain)
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 3 * r.size
    want = fill(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    # the target's end cuts one document a source
    cut = {}
    for r in got:
        cut[r.source] = cut.get(r.source, 0) + (r.size > 0 and r.taken % r.size != 0)
    assert max(cut.values(), default=0) <= 1
    return sorted(tuple(r) for r in got) if all(r.doc_id is not None and r.source is not None for r in got) else None


def test_mix_meets_targets_and_repeats(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert check_mix(docs) == check_mix(docs.repartition(7))


@pytest.mark.parametrize("block", [1, 7, 5000])
def test_mix_with_small_and_hot_sources(spark, block):
    data = [(i, "w " * (i % 13), "en", f"s{i % 4 if i % 3 else 0}", 0) for i in range(300)]
    data += [(1000, "tiny source", "en", "t", 0), (1001, "one", "en", None, 0), (1002, "x " * 4000, "en", "s1", 0)]
    check_mix(spark.createDataFrame(data, SCHEMA), block_words=block)


def test_mix_odd_rows(odd, clashing, empty):
    check_mix(odd)
    assert rows(mixing.mix(odd)) == rows(mixing.mix(clashing))
    assert mixing.mix(empty).count() == 0
    assert [r.taken for r in mixing.mix(odd.filter("doc_id in (3, 4)")).collect()] == [0, 0]


def spread(docs, window, block):
    """The farthest that a source's share of any stretch of slots is from its
    share of the whole schedule, in slots; checks the schedule against mix()."""
    got = mixing.schedule(docs, block_words=block).collect()
    taken, slots, stream = {}, {}, {}
    for r in got:
        assert 0 <= r.start < r.end
        assert slots.setdefault(r.slot, (r.source, r.rank)) == (r.source, r.rank)
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.end - r.start
        stream.setdefault(r.slot, []).append((r.at, r.end - r.start))
    assert len(set(slots.values())) == len(slots)  # each block once
    for pieces in stream.values():  # a slot's pieces follow each other
        at = 0
        for begin, n in sorted(pieces):
            assert begin == at
            at += n
        assert at <= block
    mixed = mixing.mix(docs, block_words=block).collect()
    assert {r.doc_id: r.taken for r in mixed if r.taken} == taken
    assert all((r.first_slot is None) == (r.taken == 0) for r in mixed)
    order = [slots[k][0] for k in sorted(slots)]
    share = {x: order.count(x) / len(order) for x in order}
    return max(abs(order[a:a + window].count(x) - window * share[x])
               for a in range(len(order) - window) for x in share)


def test_every_stretch_of_slots_holds_the_sources_near_their_shares(spark, monkeypatch):
    data = [(i, "w " * (20 + i % 13), "en", f"s{i % 4 if i % 3 else 0}", 0) for i in range(400)]
    docs = spark.createDataFrame(data, SCHEMA)
    assert spread(docs, 64, 16) <= 7  # the sequence's discrepancy
    monkeypatch.setattr(mixing, "_point", lambda k: F.lit(0.0) * k)
    assert spread(docs, 64, 16) > 20


def plain_verdict(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_url_rules_match_brute_force(spark):
    got = {r.page_id: r for r in QUERIES["op10_url_filter"](spark, SF001).collect()}
    pages = spark.read.parquet(f"{SF001}/pages.parquet").collect()
    odd = [None, "", "no scheme", "://", "http://", "http://COM", "http://a.com/", "http://xcom/en/", "a://É.Net/es/?q",
           "http://www.Example.com/en/x#y", "http://example.com/en", "x://y://example.com/en/", "http://a.b/c\nd?e",
           "http://" + "a/" * 40, "http://example.net/fr/" + "0" * 5000]
    table = spark.createDataFrame([(i, u, u) for i, u in enumerate(odd)] + [(0, odd[0], "x")],
                                  "page_id long, url string, host string")
    extra = urls.filter_urls(table, URL_RULES).collect()
    assert len(extra) == len(odd) + 1
    for r, url in [(got[p.page_id], p.url) for p in pages] + [(r, odd[r.page_id]) for r in extra]:
        host, path, rule, verdict = plain_verdict(url)
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert urls.filter_urls(table.limit(0), URL_RULES).count() == 0


def test_templates_reject_by_purity(spark):
    rules = (("site.org", "/spam/", "block"), ("site.org", "/news/", "allow"), ("site.org", "/shop/1", "block"))
    pages = ([f"http://site.org/spam/{i}" for i in range(30)] + [f"http://site.org/news/{i}" for i in range(30)]
             + [f"http://site.org/shop/1{i}" for i in range(30)]      # labelled block
             + [f"http://site.org/shop/2{i}" for i in range(9)]       # same template, no rule
             + [f"http://site.org/help/{i}" for i in range(9)])       # a template without labels
    table = spark.createDataFrame(list(enumerate(pages)), "page_id long, url string")
    got = urls.filter_urls(table, rules).filter("rule is null")
    verdicts = {r.t: r.v for r in got.groupBy(F.regexp_extract("path", "^/([a-z]+)", 1).alias("t")).agg(
        F.array_join(F.collect_set("verdict"), ",").alias("v")).collect()}
    assert verdicts == {"shop": "block", "help": "allow"}
    merged = urls.filter_urls(table, rules).filter("path like '/s%'").select("template").distinct().collect()
    assert [r.template for r in merged] == ["/*1/<n>"]  # spam and shop are alike, news (kind 0) differs


def test_labels_reach_unruled_urls(spark):
    """By an ancestor on the host, else by the shape over all hosts, if several
    domains label it; each of them counts alike."""
    rules = (("a.org", "/x/spam", "block"), ("a.org", "/y/", "allow"), ("b.org", "/deal/", "block"),
             ("d.org", "/deal/", "block"), ("b.org", "/one/", "block"), ("b.org", "/odd/", "block"),
             ("d.org", "/odd/", "allow"), ("d.org", "/y/", "allow"))
    pages = ([f"http://a.org/x/spam{i}/" for i in "bcdefghijk"] + [f"http://a.org/y/{i}" for i in range(8)]
             + ["http://d.org/y/1"] + [f"http://{i}.b.org/deal/{i}" for i in range(20)]
             + [f"http://d.org/deal/{i}" for i in range(10)] + [f"http://{i}.b.org/one/{i}" for i in range(30)]
             + [f"http://b.org/odd/{i}" for i in range(200)] + [f"http://d.org/odd/{i}" for i in range(6)]
             + ["http://a.org/x/other", "http://c.org/deal/77", "http://c.org/y/5", "http://c.org/z",
                "http://c.org/one/5", "http://c.org/odd/5"])
    table = spark.createDataFrame(list(enumerate(pages)), "page_id long, url string")
    got = {(r.host + r.path): (r.verdict, r.labelled) for r in
           urls.filter_urls(table, rules).filter("rule is null").collect()}
    assert got == {"a.org/x/other": ("block", 10), "c.org/deal/77": ("block", 30), "c.org/y/5": ("allow", 9),
                   "c.org/z": ("allow", 0),
                   "c.org/one/5": ("allow", 0),     # labels of one domain, on many of its hosts
                   "c.org/odd/5": ("allow", 206)}   # half blocked by domains, whatever their sizes
    alone = urls.filter_urls(table, rules, min_domains=1).filter("path = '/one/5' and host = 'c.org'").first()
    assert (alone.verdict, alone.labelled) == ("block", 30)


def test_pages_without_rule_are_judged_by_labels(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    bare = urls.filter_urls(pages, URL_RULES).filter("rule is null")
    assert not bare.filter(F.col("labelled") >= urls.MIN_LABELLED).isEmpty()


def test_deep_paths_stay_apart(spark):
    deep = "http://site.org/" + "a/" * 9
    rules = (("site.org", "/" + "a/" * 9 + "spam/", "block"), ("site.org", "/" + "a/" * 9 + "news/", "allow"))
    pages = [f"{deep}{kind}/{i}" for kind in ("spam", "news") for i in range(30)]
    table = spark.createDataFrame(list(enumerate(pages)), "page_id long, url string")
    got = {(r.verdict, r.template) for r in urls.filter_urls(table, rules).collect()}
    assert got == {("block", "/a" * 9 + "/spam/<n>"), ("allow", "/a" * 9 + "/news/<n>")}


@pytest.fixture(scope="module")
def folder(spark):
    """A documents table of odd rows, and labels."""
    def make(docs):
        path = scratch_path(spark, "odd")
        docs.write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (None, 0, 1), (8, None, None)],
                              "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
        return path
    return make


def test_stages_handle_odd_rows(spark, folder, odd, clashing, empty):
    for docs in (odd, clashing, empty):
        path = folder(docs)
        table = spark.read.parquet(f"{path}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, path)
            assert out.count() <= 3 * table.count(), name
            if name != corpus_pipeline.STAGES[-1][0]:
                assert tuple(out.columns) == corpus_pipeline.COLUMNS, name
    once = corpus_pipeline.drop_near_duplicates(spark, odd, "")
    assert sorted(str(r.doc_id) for r in once.collect()) == sorted(
        ["1", "3", "6", "7", "8", "None"])
    redacted = corpus_pipeline.redact_personal_data(spark, odd.filter("doc_id = 8"), "").first()
    assert redacted.text == "mail me at [email] or [phone]" and redacted.n_chars == len(redacted.text)
    assert corpus_pipeline.encode_tokens(spark, odd, "").count() == odd.count()
    assert corpus_pipeline.reject_toxic(spark, odd, folder(odd)).count() == odd.count()


def test_near_duplicates_go_by_row(spark):
    """Repeated and null ids: one row of each component stays, whatever its id."""
    words = [" ".join(f"{stem}{i * 7919 % 997}" for i in range(40)) for stem in "abcd"]
    table = spark.createDataFrame(
        [(1, words[0]), (5, words[0]), (1, words[1]), (0, words[1]),   # id 1 has two texts
         (7, words[2]), (7, words[2]),                                 # a repeated row
         (None, words[0]), (None, words[3]), (None, words[3])],
        "doc_id long, text string").selectExpr("doc_id", "text", "'en' lang", "'s' source", "1L n_chars")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, table, "").collect()),
                 key=repr)
    assert got == sorted([(1, words[0]), (0, words[1]), (7, words[2]), (None, words[3])], key=repr)


def test_pipeline_run(spark):
    got = QUERIES_OF_ENTRY()["pipeline"](spark, SF001)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    ids = got.select("doc_id").distinct()
    assert ids.join(docs, "doc_id", "left_anti").isEmpty() and 0 < ids.count() < docs.count()
    assert got.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3


def QUERIES_OF_ENTRY():
    import __spark_entry__
    return __spark_entry__.queries()
