"""The numbered operators: oracles, brute force, held-out accuracy, and odd rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SMALL, TINY
from quantloom.llm import chat, decontaminate, fingerprints, html_text, jaccard_join, language, merkle, mixing, near_dedup, periodic_runs, pii, quality, quality_rules, queries, substring_dedup
from quantloom.llm.jobs import components, join_hot, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}" for i in range(6_000))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "É"), (5, "É"), (None, "x y z"), (6, LONG), (7, "1 " * 5_000), (8, "z" * 20_000), (9, "a\x00b c 😀 d"), (6, LONG + " tail")]


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, empty and very long texts, repeated rows, and columns whose names clash with the results'."""
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    extra = {c: F.lit("x") for c in ("n_words", "score", "spans", "base", "fp", "size", "hash", "row", "block", "words", "good", "taken", "kept", "items", "before", "gone", "key", "copy", "n", "tie", "at", "raw_email", "may_card", "part")}
    return df.withColumns({"lang": F.lit("en"), "source": F.when(F.col("doc_id") == 1, None).otherwise("s"), **extra})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(1, 9)] + [(None, 1, 0), (3, None, 0), (4, 7, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_oracle(spark, same, name):
    same(queries.QUERIES[name](spark, TINY), queries.ORACLE_SQL[name])


# 1 chat


def turns(spark, rows):
    return spark.createDataFrame(rows, "pair_id long, turn long, role string, text string")


def test_preferences_share_their_prefix_once(spark):
    c = turns(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "good"), (2, 0, "user", "same"), (3, 0, None, None), (None, 0, "user", "x")])
    r = turns(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "bad"), (2, 0, "user", "same"), (4, 0, "user", "only")])
    got = {x.pair_id: x for x in chat.format_preferences(c, r).collect()}
    one = got[1]
    assert set(got) == {1, 2, 3, 4} and one.n_common == 1
    assert one.prompt == "<|user|>\nhi<|end|>\n" and one.chosen == "<|assistant|>\ngood<|end|>\n"
    assert [one.chosen[m.start : m.end] for m in one.chosen_mask] == ["good<|end|>\n"] and [one.rejected[m.start : m.end] for m in one.rejected_mask] == ["bad<|end|>\n"]
    assert got[2].identical and got[2].chosen == "" and got[3].chosen == "<|unknown|>\n<|end|>\n" and got[4].n_common == 0 and not got[4].chosen
    assert chat.format_preferences(c.limit(0), r.limit(0)).count() == 0


# 2 decontamination


@pytest.mark.parametrize("block", [200_000, 50])
def test_decontamination_in_blocks(spark, block):
    docs = table(spark, TINY, "documents")
    got = decontaminate.decontaminate(docs, table(spark, TINY, "benchmark"), block_phrases=block)
    want = decontaminate.decontaminate(docs, table(spark, TINY, "benchmark"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_many_blocks_are_live_one_at_a_time(spark):
    got = decontaminate.decontaminate(table(spark, TINY, "documents"), table(spark, TINY, "benchmark"), block_phrases=20)
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_decontamination_spans_and_odd_rows(spark, odd):
    item = " ".join(f"w{i}" for i in range(100, 120))
    marks = spark.createDataFrame([(1, item), (1, item), (2, "É"), (3, None), (None, "a"), (4, "!!")], "item_id long, text string")
    got = decontaminate.decontaminate(odd, marks, keep=True).collect()
    assert len(got) == len(ODD)
    for r in got:
        if r.doc_id == 6:
            assert r.items == ["1"] and r.n_hit == 20 * len(re.findall(r"w100 w101 ", LONG)) and not r.contaminated
            assert all((r.row.text[c.start : c.end]).startswith("w100 ") for c in r["cuts"])
        elif r.doc_id == 5:
            assert r.items == ["2"] and r.contaminated
        else:
            assert not r.n_hit and not r.contaminated
    assert decontaminate.decontaminate(odd, marks.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
    assert decontaminate.decontaminate(odd.limit(0), marks).count() == 0


def test_fm_index_against_search():
    rng = np.random.default_rng(1)
    runs = [rng.integers(1, 4, size=n) for n in (30, 5, 1, 17, 30)] + [np.array([1, 2, 3, 1, 2, 3])] * 2
    seq = np.concatenate([np.append(r, 0) for r in runs])
    index = decontaminate.FMIndex(seq, 4, sample=4)
    for n in (1, 2, 3, 6):
        for phrase in rng.integers(1, 4, size=(20, n)):
            want = [i for i in range(len(seq) - n + 1) if (seq[i : i + n] == phrase).all()]
            low, high = index.find(phrase[None])
            assert sorted(index.locate(np.arange(low[0], high[0])).tolist()) == want


# 3 and 4, 7: classifiers


def test_language_accuracy_and_odd_rows(spark, odd):
    docs = table(spark, SMALL, "documents")
    model = language.train(docs)
    got = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got) and all(0 <= r.score <= 1 for r in got)
    rows = language.identify(odd, model).collect()
    assert len(rows) == len(ODD) and all(r.lang_pred == "und" for r in rows if r.doc_id in (1, 2, 3, 7)) and all(r.lang_pred != "und" for r in rows if r.doc_id in (4, 5, 6))
    assert language.identify(odd, language.train(odd.limit(0))).where("lang_pred <> 'und'").count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_language_of_equal_rows_is_learnt_whatever_the_seed(spark, seed):
    """5,000 rows of one text are one text of the sample, neither thousands nor none."""
    rows = [(i, "the very same notice of the harbour office", "aa") for i in range(5000)] + [(9000 + i, f"waarom zou {i} het anders willen dan zo {i * i}", "bb") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(df, lang_rows=100, seed=seed)
    assert set(model.languages) == {"aa", "bb"} and model.languages.count("aa") == 1
    got = {r.lang: r.lang_pred for r in language.identify(df, model).join(df.select("doc_id", "lang"), "doc_id").select("lang", "lang_pred").distinct().collect()}
    assert got == {"aa": "aa", "bb": "bb"}


def test_many_languages_share_the_sample_and_too_many_are_an_error(spark):
    rows = [(10 * i + j, f"{'abcdefghijklmnopqrst'[i % 20] * 3} {'klmnopqrstuvwxyzabcd'[i // 20] * 4} {j}", f"l{i:03d}") for i in range(200) for j in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(df, most_rows=400, most_languages=200)
    assert len(set(model.languages)) == 200 and len(model.languages) <= 400
    with pytest.raises(ValueError, match="more than 199"):
        language.train(df, most_languages=199)


def test_quality_accuracy_and_odd_rows(spark, odd, labels):
    docs, marks = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    scored = quality.score(docs, quality.train(docs, marks)).join(marks, "doc_id").collect()
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum((r.score >= 0.3) == (r.quality == 1) for r in held) >= 0.95 * len(held)
    got = quality.score(odd, quality.train(odd, labels)).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    other = quality.score(odd.withColumnRenamed("text", "body").withColumn("text", F.lit("x")), quality.train(odd, labels), "body").collect()
    assert sorted((str(r.doc_id), str(r.body), r.text, r.score) for r in other) == sorted((str(r.doc_id), str(r.text), "x", r.score) for r in got)
    assert quality.score(odd, quality.train(odd, labels.limit(0))).select("score").distinct().count() == 1
    assert quality.score(odd.limit(0), quality.train(odd.limit(0), labels)).count() == 0


def brute_counts(x):
    x = x or ""
    w = WORD.findall(x)
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n, cover = Counter(grams), set()
    for i, g in enumerate(grams):
        if n[g] > 1:
            cover.update(range(i, i + 8))
    lines = [line for line in x.split("\n") if WORD.search(line)]
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), len(lines) - len(set(lines)), len(cover)]


def test_quality_rule_counts(texts):
    sample = [*texts.values(), *[t for _, t in ODD]]
    got = quality_rules.statistics([(t or "").encode() for t in sample])[:, :5]
    assert got.tolist() == [brute_counts(t) for t in sample]


def test_quality_rules_verdicts(spark, odd, labels):
    docs, marks = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    got = {r.doc_id: r for r in quality_rules.judge(docs, quality_rules.train(docs, marks)).collect()}
    held = [r for r in marks.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum((got[r.doc_id].score >= 0.3) == (r.quality == 1) for r in held) >= 0.93 * len(held)
    assert all(r.kept == (not r.base_failed and r.score >= 0.3) for r in got.values())
    rows = quality_rules.judge(odd, quality_rules.train(odd, labels)).collect()
    assert len(rows) == len(ODD) and all(r.base_failed for r in rows if r.doc_id in (1, 2, 3, 4))
    assert quality_rules.judge(odd.limit(0), quality_rules.train(odd.limit(0), labels)).count() == 0


def test_trees_respect_their_constraints():
    rng = np.random.default_rng(2)
    x = rng.random((800, 2))
    good = rng.random(800) < 1 / (1 + np.exp(6 * x[:, 0] - 3 + 2 * np.sin(9 * x[:, 0])))
    trees = quality_rules.boost(x, good, (-1, 0), rounds=20)
    for other in (0.1, 0.5, 0.9):
        line = trees.scores(np.stack((np.linspace(0, 1, 200), np.full(200, other)), axis=1))
        assert (np.diff(line) <= 1e-12).all() and line[0] > line[-1]


# 5 substring deduplication


def brute_removed(rows, window=13):
    first = {}
    key = lambda d: (d is None, d or 0)
    split = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - window + 1):
            g = tuple(w[i : i + window])
            first[g] = min(first.get(g, key(d)), key(d))
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < key(d):
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_passages_against_brute_force(spark, odd):
    rng = np.random.default_rng(5)
    shared = [" ".join(f"v{x}" for x in rng.integers(0, 6, size=n)) for n in (13, 14, 30, 60)]
    rows = [(int(i), " ".join([*(f"u{x}" for x in rng.integers(0, 5, size=rng.integers(0, 20))), shared[rng.integers(4)], *(f"u{x}" for x in rng.integers(0, 3, size=rng.integers(0, 40)))])) for i in rng.permutation(120)]
    for data in (rows, ODD):
        df = spark.createDataFrame(data, "doc_id long, text string")
        got = substring_dedup.dedup_passages(df, block_chars=500, shard_chars=900).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == brute_removed(data)
    last = spark.createDataFrame([(1, LONG), (2**63 - 1, LONG), (None, "x")], "doc_id long, text string")
    assert {(r.doc_id, r.n_removed > 0) for r in substring_dedup.dedup_passages(last).collect()} == {(1, False), (2**63 - 1, True), (None, False)}
    assert substring_dedup.dedup_passages(odd).count() == len(ODD) and substring_dedup.dedup_passages(odd.limit(0)).count() == 0


def test_no_shard_gathers_a_hot_minimizer(spark):
    line = " ".join(f"licence{i}" for i in range(30))
    rows = [(i, f"{' '.join(f'a{i}b{j}' for j in range(15))} {line} {' '.join(f'c{i}d{j}' for j in range(15))}" if i % 3 == 0 else f"own{i} " * 20) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.dedup_passages(df, block_chars=500, shard_chars=900, hot_passages=20).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == brute_removed(rows)

    def block(part):
        ids, texts = [d for d, _ in part], [t for _, t in part]
        return pa.table({"block": pa.array([part[0][0]] * len(part), pa.int64()), "doc_id": pa.array(ids, pa.int64()), "text": texts, "row": pa.array(ids, pa.int64())})

    blocks = [block(rows[i : i + 10]) for i in range(0, 600, 10)]
    answers = substring_dedup._answer_minimizers(pa.concat_tables([substring_dedup._ask_minimizers(b, 13, 1) for b in blocks]), 20).to_pylist()
    passages = set()
    for b, a in zip(blocks, answers, strict=True):
        for r in substring_dedup._ask_passages(b, pa.Table.from_pylist([a]), 13, 1).to_pylist():
            passages.update(zip(r["value"], r["passage"], strict=True))
    assert max(Counter(v for v, _ in passages).values()) <= 20


def test_automaton_finds_the_smallest_document():
    rng = np.random.default_rng(6)
    for _ in range(30):
        seqs = [([b"%d" % x for x in rng.integers(0, 3, size=rng.integers(4, 12))], int(d)) for d in rng.integers(0, 9, size=5)]
        automaton = substring_dedup.SuffixAutomaton()
        for w, d in seqs:
            automaton.add(w, d)
        automaton.close()
        query = [b"%d" % x for x in rng.integers(0, 3, size=15)]
        want = [min((d for w, d in seqs if any(w[j : j + 4] == query[i : i + 4] for j in range(len(w) - 3))), default=substring_dedup._LAST) for i in range(12)]
        assert automaton.statistics(query, 4) == want


# 6 html

PAGE = """<html><body><nav><a href=x>Home</a></nav><div class="ad">Buy now</div><article><h1>T &amp; t</h1><p>Fo<b>o</b> bar
 baz.<br><p>More&nbsp;text here.</article><footer>&copy; me</footer><script>var x = "<p>no</p>";</script></body></html>"""


def test_blocks_of_a_page():
    assert [b.text for b in html_text.blocks_of(PAGE)] == ["Home", "Buy now", "T & t", "Foo bar baz.", "More text here.", "© me"]
    for broken in ("", "<", "<p", "a < b", "<!-- x", "<script>x", "</p></p>", "<p>" * 3000, "<a href='x>y</a>"):
        html_text.blocks_of(broken)


#: Pages written by hand with their main text: markup that names its parts, and markup that says nothing of them.
STORY = "The town has built a new bridge over the harbour, which opened on Monday after three years of work."
MORE = "It is four hundred metres long, and some twenty thousand cars are expected to cross it every day."
END = "The old bridge will be taken down in spring, as its iron has become too weak to carry lorries."
BY_HAND = [
    (f"<html><body class='has-sidebar'><div class='page-with-header'><header><a href=/>Daily Post</a></header><nav><a href=/a>Home</a> <a href=/b>News</a></nav><main><article><header><h1>A new bridge</h1></header>"
     f"<p>{STORY}</p><p>{MORE}</p><aside><p>Related: how bridges are built and who pays for them in the end.</p></aside><p>{END}</p></article></main>"
     "<section id='comments'><h3>3 comments</h3><div class='comment'><p>I cross it every day and it was closed for weeks.</p></div></section><footer>&copy; Daily Post.</footer></div></body></html>", f"A new bridge {STORY} {MORE} {END}"),
    (f"<html><body><div class='cookie-notice'><p>We use cookies to make this site work. By reading on you agree.</p></div><div id='page'><div class='content'><h2>A new bridge</h2><p>{STORY}</p><ul><li>It is long.</li></ul>"
     f"<div class='ad'><p>Buy the best saws in our shop today, now with free delivery.</p></div><p>{END}</p></div><div class='sidebar'><h3>Popular</h3><p>Ten plants for shady gardens that everyone can grow.</p></div></div>"
     "<form><p>Subscribe to our newsletter.</p></form></body></html>", f"A new bridge {STORY} It is long. {END}"),
    (f"<html><body><div class=x1><ul class=q><li><a href=/a>Home</a></li><li><a href=/b>World</a></li><li><a href=/c>Sport</a></li></ul></div><div class='x2 col'><h1>A new bridge</h1><p>{STORY}</p><p>{MORE}</p><p>{END}</p></div>"
     "<div class=x3><span><a href=/e>Imprint</a></span><span>&copy; 2021 Gazette</span></div></body></html>", f"A new bridge {STORY} {MORE} {END}"),
    (f"<html><body><table><tr><td><a href=1>Index</a></td><td><a href=2>Archive</a></td></tr></table><div><div><p>{STORY}</p><p>{END}</p></div></div><div><a href=4>Next page</a></div></body></html>", f"{STORY} {END}"),
]


def test_names_around_a_block():
    says = lambda *path: html_text.named_main(path)
    assert not says("html", "body", "div", ".random") and says("html", "body", "div", ".content", "p") and says("article", "header", "h1")
    assert not says("header", "h1") and not says("article", "footer", "p") and not says("div", ".sidebar", "div", ".content") and says("div", ".sidebar", "article", "p")
    assert not says("section", ".comments", "article", "p") and not says("body", ".content", "p")


def test_pages_give_their_articles(spark):
    pages = table(spark, SMALL, "pages")
    model = html_text.train(pages, fit_pages=120)
    source = {r.page_id: r.html for r in pages.collect()}
    good = 0
    for r in html_text.extract(pages, model).collect():
        main = re.search(r"<article>(.*)</article>", source[r.page_id], re.S)[1]
        good += r.text == " ".join(b.text for b in html_text.blocks_of(main)) and r.n_chars == len(r.text)
    assert good >= 0.98 * len(source)
    odd = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "u", PAGE), (3, "u", "<p>" + "word " * 40_000), (3, "u", "<p>x")], "page_id long, url string, html string")
    odd = odd.withColumns({c: F.lit("x") for c in ("text", "n_chars", "n_blocks", "h")})
    got = html_text.extract(odd, model).collect()
    assert len(got) == 5 and [r.text for r in got if r.page_id in (1, 2)] == ["", ""]
    assert html_text.extract(odd.limit(0), html_text.train(odd.limit(0))).count() == 0


def test_pages_written_by_hand(spark):
    model = html_text.train(table(spark, SMALL, "pages"))
    for page, want in BY_HAND:
        blocks = html_text.blocks_of(page)
        told = {id(b): c >= 0.5 for b, c in zip(blocks, model.of_blocks([blocks])[0], strict=True)}
        right = sum(len(b.text) for b in blocks if told[id(b)] == (b.text in want))
        assert right >= 0.9 * sum(len(b.text) for b in blocks), page
    # Other pages' blocks, dealt into layouts that name nothing.
    rng, right, total = np.random.default_rng(9), 0, 0
    for r in table(spark, TINY, "pages").collect():
        blocks = html_text.blocks_of(r.html)
        main, noise = ([b for b, t in zip(blocks, html_text.named(blocks), strict=True) if t is kind] for kind in (True, False))
        dealt, want = html_text._unnamed(main, noise, rng)
        for b, c, w in zip(dealt, model.of_blocks([dealt])[0], want, strict=True):
            right, total = right + len(b.text) * ((c >= 0.5) == w), total + len(b.text)
    assert right >= 0.95 * total


# 8 near-duplicates


def brute_fingerprint(text):
    w = (text or "").encode().translate(fingerprints._LOWER).split()
    shingles = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_classes(fps):
    least, parent = {}, {f: f for f in fps}
    root = lambda f: f if parent[f] == f else root(parent[f])
    for a, b in combinations(sorted(set(fps)), 2):
        if (a ^ b).bit_count() <= 4:
            parent[root(a)] = root(b)
    for f, d in fps.items():
        if d is not None:
            least[root(f)] = min(least.get(root(f), d), d)
    return {f: least.get(root(f)) for f in fps}


def test_near_duplicates_against_brute_force(spark, odd, texts):
    rows = [*list(texts.items())[:400], *ODD]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by_fp = {}
    for d, t in rows:
        f = brute_fingerprint(t)
        by_fp[f] = min((x for x in (by_fp.get(f), d) if x is not None), default=None)
    classes = brute_classes(by_fp)
    want = sorted(((d, brute_fingerprint(t), classes[brute_fingerprint(t)]) for d, t in rows), key=str)
    assert sorted(((r.doc_id, int(np.int64(r.fp).view(np.uint64)), r.component_id) for r in got), key=str) == want
    assert near_dedup.near_duplicates(odd.limit(0)).count() == 0


def test_every_four_positions_hold_a_triple():
    assert len(near_dedup.TRIPLES) == 20
    assert all(any(set(t) <= set(q) for t in near_dedup.TRIPLES) for q in combinations(range(8), 4))


@pytest.mark.parametrize("list_rows", [4096, 256])
def test_links_connect_what_all_pairs_connect(spark, list_rows):
    rng = np.random.default_rng(7)
    centres = rng.integers(0, 1 << 63, size=4).tolist()
    values = set(centres)
    for i, c in enumerate(centres):
        for _ in range(600 if i < 2 else 20):
            # The first two are long lists: their members differ in few places.
            values.add(c ^ sum(1 << int(b) for b in rng.choice(18 if i < 2 else 64, size=rng.integers(1, 7), replace=False)))
    fps = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    roots = {r.node: r.root for r in components(near_dedup.fingerprint_links(fps, list_rows=list_rows)).collect()}
    mine = {}
    for v in values:
        k = int(np.uint64(v).view(np.int64))
        mine.setdefault(roots.get(k, k), set()).add(v)
    want = {}
    for v, c in brute_classes({v: i for i, v in enumerate(sorted(values))}).items():
        want.setdefault(c, set()).add(v)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def test_no_join_gathers_a_hot_key(spark):
    rows = spark.createDataFrame([(7 if i % 3 else i, i) for i in range(3000)] + [(None, 1)], "k long, v long")
    facts = rows.groupBy("k").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    want = sorted(map(tuple, rows.join(facts.drop("n"), "k").select("k", "v", "m").collect()))
    got = join_hot(rows, facts, "k", 3000)
    assert sorted(map(tuple, got.select("k", "v", "m").collect())) == want
    assert components(spark.createDataFrame([(0, i) for i in range(1, 2500)] + [(5000, 5001), (None, 3), (4, 4)], "a long, b long")).groupBy("root").count().orderBy("root").collect() == [(0, 2500), (5000, 2)]


def test_one_row_of_each_class_stays(spark, odd):
    got = near_dedup.near_duplicates(odd, keep=True)
    classes = {r.component_id for r in near_dedup.near_duplicates(odd).collect()}
    assert got.columns == odd.columns and got.count() == len(classes)
    assert {r.doc_id for r in got.collect()} == classes and not {r.text for r in got.collect()} - {t for _, t in ODD}


def test_fingerprint_query_against_brute_force(spark):
    rows = table(spark, TINY, "documents").select("doc_id", "text").collect()
    fps = {r.doc_id: brute_fingerprint(r.text) for r in rows}
    least = {}
    for d, f in fps.items():
        least[f] = min(least.get(f, d), d)
    classes = brute_classes(least)
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in queries.QUERIES["op8_near_duplicates"](spark, TINY).collect()}
    assert got == {(d, f"{f:016x}", classes[f]) for d, f in fps.items()}


# 9 mixing


def test_targets_are_dealt_by_weight_and_capped():
    got = mixing.source_targets({"b": 100, "a": 1000, None: 10, "c": 0})
    assert got["b"] == 200 and got[None] == 20 and got["c"] == 0 and abs(sum(got.values()) - 1.5 * 1110) < 1e-6
    assert mixing.source_targets({}) == {}


def test_mix_meets_its_targets_and_repeats_itself(spark, odd):
    docs = table(spark, SMALL, "documents")
    small = [sorted(map(tuple, mixing.mix_sources(d, block_rows=16).collect()), key=str) for d in (docs, docs.repartition(3))]
    assert small[0] == small[1]
    runs = [sorted(tuple(r) for r in mixing.mix_sources(d).select("doc_id", "size", "target", "taken", "repeats", "source").collect()) for d in (docs, docs.repartition(7))]
    assert runs[0] == runs[1] and all(r[3] in (0, r[1], 2 * r[1]) for r in runs[0])
    by = {}
    for _, _, target, taken, _, source in runs[0]:
        by.setdefault(source, [target, 0])[1] += taken
    # Fifty documents a source: one may be longer than the others can make up for without changing its chance.
    apart = [abs(got - target) / target for target, got in by.values() if target]
    assert np.median(apart) <= 0.005 and np.mean(apart) <= 0.02 and max(apart) <= 0.1
    rows = mixing.mix_sources(odd).collect()
    assert len(rows) == len(ODD) and {r.taken for r in rows if r.source is None} == {0}
    assert mixing.mix_sources(odd.limit(0)).count() == 0


def test_flight_keeps_both_sums():
    rng = np.random.default_rng(8)
    sizes, chance = np.sort(rng.integers(1, 900, size=300))[::-1].astype(float), np.full(300, 0.37)
    p = mixing.flight(sizes, chance, rng)
    assert sum((p > 0) & (p < 1)) <= 2 and abs(p.sum() - 111) < 1e-6 and abs(sizes @ p - 0.37 * sizes.sum()) < 1e-6
    assert sizes[(p > 0) & (p < 1)].max(initial=0) <= 50
    assert mixing.flight(np.zeros(5), np.full(5, 0.4), rng).sum() == pytest.approx(2.0)


def test_landing_changes_no_chance_on_average():
    sizes, chance = np.array([6000, 500, 400, 400, 300, 200, 100, 90, 80, 0.0]), np.array([0.3, 0.5, 0.2, 0.7, 0.4, 0.6, 0.5, 0.5, 0.3, 0.3])
    drawn = np.array([mixing.landing(sizes, chance, np.random.default_rng(i)) for i in range(3000)])
    assert set(np.unique(drawn)) == {0, 1} and np.abs(drawn.mean(axis=0) - chance).max() < 0.035
    even = np.sort(np.random.default_rng(1).integers(50, 900, size=200))[::-1].astype(float)
    landed = mixing.landing(even, np.full(200, 0.37), np.random.default_rng(2))
    assert abs(even @ landed - 0.37 * even.sum()) <= 100 and abs(landed.sum() - 74) <= 5


def settled(sizes, chance, seed):
    """What becomes of a source's last block."""
    rows = pd.DataFrame({"doc_id": range(len(sizes)), "size": sizes, "chance": chance, "draw": np.random.default_rng(seed).random(len(sizes)), "last": True})
    done = mixing._settle(rows)
    assert set(done["chance"]) <= {0.0, 1.0}
    return done


@pytest.mark.parametrize(("rows", "chance", "spread"), [(200, 0.2, 1.0), (200, 0.37, 1.2), (1000, 0.05, 1.0)])
def test_last_blocks_keep_words_and_documents(rows, chance, spread):
    words, documents = [], []
    for seed in range(12):
        sizes = np.floor(np.random.default_rng(seed).lognormal(5, spread, rows) + 1)
        done = settled(sizes, np.full(rows, chance), seed)
        words.append(abs(done["size"] @ done["chance"] / (chance * sizes.sum()) - 1))
        documents.append(abs(done["chance"].sum() - chance * rows))
    assert max(words) <= 0.01 and np.mean(documents) <= 0.5 and max(documents) <= 2


def test_an_outsize_row_is_made_up_for_in_words():
    # Equal sizes beside one other: both constraints pin it.
    sizes = np.array([15_000.0] + [100.0] * 400)
    for seed in range(8):
        done = settled(sizes, np.full(401, 0.3), seed)
        assert abs(done["size"] @ done["chance"] / (0.3 * sizes.sum()) - 1) <= 0.02
    assert abs(np.mean([settled(np.array([900.0, 100, 100, 50, 50, 20, 10]), np.full(7, 0.4), s)["chance"].to_numpy() for s in range(1500)], axis=0) - 0.4).max() < 0.05


def test_mix_keeps_document_totals(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "w " * int(rng.lognormal(3, 0.9) + 1), f"s{i % 3}") for i in range(1500)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy("source").agg(
        F.sum("repeats").alias("n"), F.sum(F.col("target") / F.col("source_size")).alias("documents"), F.sum("taken").alias("taken"), F.first("target").alias("target"))
    for r in got.collect():
        assert abs(r.n - r.documents) <= 0.01 * r.documents and abs(r.taken - r.target) <= 0.005 * r.target


def test_equal_rows_are_dealt_to_many_blocks(spark):
    df = spark.createDataFrame([(1, "a b c", "s")] * 3000 + [(2, "d", "s")], "doc_id long, text string, source string")
    got = mixing.mix_sources(df, block_rows=64)
    assert got.count() == 3001 and abs(got.agg(F.sum("taken")).first()[0] - 1.5 * 9001) <= 3
    assert max(r.n for r in mixing._copies(spark.createDataFrame([(5, 10_000)], "key long, n long")).groupBy("copy").agg(F.count("*").alias("n")).collect()) == 1


# 10 personal data


def passes_luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_spans(x):
    x, out = x or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and passes_luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


HARD = [
    "a@b.c%d@e.f x@y.z q@@r.s .@-.-", "1.2.3.4.5.6.7.8 1.2.3.400 0001.02.3.4 1.2.3", "+1 555 555 5555 4111 1111 1111 1111 😀 4111-1111-1111-1111", "+1+12345678901+1 ", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1",
    "x@y a.b@c.d.e.f-", "😀é 10.0.0.1, (555) 123-4567 +49 (30) 1234-5678.", "a." * 3000 + "@", "4111111111111111 1 4111111111111111", "12-34--56 7 8  9",
    *[f"call +1{gap}2{gap}3{gap}4{gap}5{gap}6{gap}7{gap}8{gap}9 now" for gap in ("", " ", " .", "   ", "(  )", " . . ")], "4" + " 1" * 15, "1.2.3.4" * 3, "+" * 50 + "1 2", "@" * 300, "1-" * 3000,
]


def test_base_spans_against_brute_force(spark, odd, texts):
    rows = [*texts.items(), *[(10_000 + i, t) for i, t in enumerate(HARD)], *ODD]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(df)
    got = pii.find_pii(df, model).collect()
    assert len(got) == len(rows)
    for r in got:
        base = [(s.start, s.kind, s.end) for s in r.base]
        assert base == brute_spans(r.text), r.text[:80]
        assert set(base) <= {(s.start, s.kind, s.end) for s in r.spans}
    clean = {r.doc_id: r.text for r in pii.redact(df, model).where("doc_id IS NOT NULL").collect()}
    assert clean[10_003] == "+1[PHONE]+1 " and clean[4] == "a"
    assert all(not brute_spans(t) or "[" in t for t in clean.values())
    assert pii.find_pii(odd).count() == len(ODD) and pii.find_pii(odd.limit(0), pii.fit(odd.limit(0))).count() == 0


def test_personal_data_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in table(spark, TINY, "documents").collect()}
    for r in queries.QUERIES["op10_pii"](spark, TINY).collect():
        base = brute_spans(texts[r.doc_id])
        told = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest() and set(told) <= set(filter(None, r.spans.split(",")))


def test_precision_and_recall_of_added_spans(spark, texts):
    """Other forms planted between words of the given documents, and numbers that are no personal data; the fit sees both."""
    rng, rows, want = np.random.default_rng(11), [], {}
    good = {"email": ["joe{} (at) example (dot) com", "ann.b{}[at]mail[dot]example[dot]org"], "phone": ["(555) 123-4{:03d}", "+1/555/123/4{:03d}"], "ip": ["2001:0db8:85a3:0000:0000:8a2e:0370:7{:03d}"]}
    bad = ["chapter {} of 12 and 34", "in 1999 and 20{}", "scores 3:1, 2:2 and {}:0", "look (at) page {}"]
    words = [t for t in texts.values() if t and not brute_spans(t) and not re.search("[0-9@]", t)][:150]
    for i, t in enumerate(words):
        kind = list(good)[i % 3] if i % 2 else None
        text = (good[kind][i % len(good[kind])] if kind else bad[i % len(bad)]).format(i)
        left, right = " ".join(t.split()[:6]), " ".join(t.split()[6:12])
        rows.append((-1 - i, f"{left} {text} {right}"))
        want[-1 - i] = {(kind, len(left) + 1, len(left) + 1 + len(text))} if kind else set()
    df = spark.createDataFrame([*texts.items(), *rows], "doc_id long, text string")
    got = {r.doc_id: {(pii.KINDS[s.kind], s.start, s.end) for s in r.spans} for r in pii.find_pii(df.where("doc_id < 0"), pii.fit(df)).collect()}
    hit, told, real = (sum(map(len, x)) for x in ([got[i] & want[i] for i in want], got.values(), want.values()))
    print(f"added spans: precision {hit / told:.3f}, recall {hit / real:.3f} of {real}")
    assert hit >= 0.9 * told and hit >= 0.9 * real


def test_added_spans_are_of_other_forms(spark, texts):
    df = spark.createDataFrame([*texts.items(), (-1, "write to joe (at) example (dot) com"), (-2, "only 12 of 34 at 5.6 and 7:30")], "doc_id long, text string")
    # The first row's form is unknown to the base patterns, so it must not be learnt as a wrong one.
    got = {r.doc_id: r for r in pii.find_pii(df.where("doc_id < 0"), pii.fit(df.where("doc_id >= 0"))).collect()}
    assert [pii.KINDS[s.kind] for s in got[-1].spans] == ["email"] and not got[-1].base and not got[-2].spans


def test_digits_far_apart_are_a_phone_number(spark):
    df = spark.createDataFrame([(1, "so +4 - 9 - 3 - 0 - 1 - 2 - 3 - 4 - 5"), (2, "+4 - 9 - 3")], "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.kind, s.end) for s in r.base] for r in pii.find_pii(df).collect()}
    assert got == {1: brute_spans("so +4 - 9 - 3 - 0 - 1 - 2 - 3 - 4 - 5"), 2: []} and len(got[1]) == 1


BESIDE = [
    (-1, "Pour +1 (826) 555-4081 190.137.223.204 du", "Pour [PHONE] [IP] du"),
    (-3, "an é.müller@mail.example.com. Then", "an [EMAIL][EMAIL]. Then"),
    (-4, "no 20 of 34 at 5.6 and 7:30", "no 20 of 34 at 5.6 and 7:30"),
]


def test_data_beside_other_data_is_found(spark, texts):
    df = spark.createDataFrame([*texts.items(), *[(i, t) for i, t, _ in BESIDE]], "doc_id long, text string")
    model = pii.fit(df.where("doc_id >= 0"))
    got = {r.doc_id: r.text for r in pii.redact(df.where("doc_id < 0"), model).collect()}
    assert got == {i: clean for i, _, clean in BESIDE}


OTHER = [
    (-10, "write joe (at) example (dot) com now", "write [EMAIL] now"),
    (-11, "ring (555) 123-4567 now", "ring [PHONE] now"),
    (-12, "paid 4111.1111.1111.1111 now", "paid [CARD] now"),
    (-13, "from 2001:0db8:85a3:0000:0000:8a2e:0370:7334 now", "from [IP] now"),
    (-14, "en 7536784127813050 4845168114407329 que", "en [CARD] [CARD] que"),
    (-15, "sums 12 345 678 901 23 and 4 5 6, ratio 10:20:30:40:50:10:20:30", "sums 12 345 678 901 23 and 4 5 6, ratio 10:20:30:40:50:10:20:30"),
]


def test_other_forms_among_the_fitted_documents(spark, texts):
    rows = [*texts.items(), *[(100 * i - n, t.replace("now", f"now{n}")) for i, t, _ in OTHER for n in range(40)]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(df, pii.fit(df)).where("doc_id < 0 AND doc_id % 100 = 0").collect()}
    assert got == {100 * i: clean.replace("now", "now0") for i, _, clean in OTHER}


# pipeline

CLASH = ("before", "gone", "hash", "score", "row", "spans", "base", "fp", "items", "key", "repeats", "size")


@pytest.fixture(scope="module")
def crowd(spark):
    """The tiny documents, the odd ones, and rows that share an id or everything, with columns named like those inside."""
    docs = table(spark, TINY, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    some = docs.orderBy("doc_id").limit(3)
    odd = spark.createDataFrame([(d, t, "en", None if d == 1 else "s", len(t or "")) for d, t in ODD], docs.schema)
    twice = spark.createDataFrame([(5, f"{i} " + " ".join(f"only{i}x{j}" for j in range(60)), "en", "s", 7) for i in range(2)], docs.schema)
    return docs.unionByName(some).unionByName(odd).unionByName(twice).withColumns({c: F.lit(c) for c in CLASH}).cache()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_pipeline_quality_stage(spark, crowd):
    import corpus_pipeline as cp

    model = quality.train(crowd, table(spark, TINY, "labels"))
    rows = crowd.collect()
    scores = model.scores([(r.text or "").encode() for r in rows])
    assert rows_of(cp.keep_quality(spark, crowd, TINY)) == sorted((tuple(r) for r, s in zip(rows, scores, strict=True) if s >= 0.3), key=repr)


def test_pipeline_near_duplicates_stage(spark, crowd):
    import corpus_pipeline as cp

    rows, best = crowd.collect(), {}
    fps = [brute_fingerprint(r.text) for r in rows]
    classes = brute_classes({f: f for f in fps})
    for r, f in zip(rows, fps, strict=True):
        best.setdefault(classes[f], []).append((r.doc_id is None, r.doc_id or 0, f, r))
    got = cp.drop_near_duplicates(spark, crowd, TINY).collect()
    assert len(got) == len(best) and got[0].asDict().keys() == rows[0].asDict().keys()
    left = {brute_fingerprint(r.text): r for r in got}
    for members in best.values():
        first = min(m[:3] for m in members)
        assert left[first[2]].doc_id == (None if first[0] else first[1]) and left[first[2]] in [m[3] for m in members if m[:3] == first]


def test_pipeline_decontamination_stage(spark, crowd):
    import corpus_pipeline as cp

    word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: word.findall((t or "").translate(lower))
    windows = {}
    for r in table(spark, TINY, "benchmark").collect():
        w = split(r.text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows.setdefault(n, set()).add(tuple(w[i : i + n]))
    def clean(t):
        w, hit = split(t), set()
        for n, known in windows.items():
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in known:
                    hit.update(range(i, i + n))
        return not hit or 20 * len(hit) < len(w)
    assert rows_of(cp.drop_contaminated(spark, crowd, TINY)) == sorted((tuple(r) for r in crowd.collect() if clean(r.text)), key=repr)


def test_pipeline_personal_data_stage(spark, crowd):
    import corpus_pipeline as cp

    def cut_out(t, spans):
        out, at = "", 0
        for s, k, e in spans:
            if s >= at:
                out, at = out + t[at:s] + f"[{pii.KINDS[k].upper()}]", e
            at = max(at, e)
        return out + t[at:]

    want = []
    for r in pii.find_pii(crowd.drop("base", "spans"), pii.fit(crowd)).collect():
        told, row = sorted((s.start, s.kind, s.end) for s in r.spans), r.asDict() | {"base": "base", "spans": "spans"}
        assert {(s, k, e) for s, k, e in brute_spans(r.text)} <= set(told)
        if told:
            row |= {"text": cut_out(r.text, told)}
            row |= {"n_chars": len(row["text"])}
        want.append(tuple(row[c] for c in crowd.columns))
    got = cp.redact_personal(spark, crowd, TINY)
    assert got.columns == crowd.columns and rows_of(got) == sorted(want, key=repr)


def test_pipeline_mixing_stage(spark, crowd):
    import corpus_pipeline as cp

    rows = crowd.collect()
    got = cp.mix(spark, crowd, TINY).collect()
    size = lambda t: len(WORD.findall(t or ""))
    targets = mixing.source_targets({k: sum(size(r.text) for r in rows if r.source == k) for k in {r.source for r in rows}})
    copies = Counter(tuple(r[c] for c in crowd.columns if c not in ("size", "repeats")) for r in rows)
    assert len({(r.doc_id, r.text, r.source) for r in got}) == len(got)
    for r in got:
        assert 0 < r.repeats <= 2 * copies[tuple(r[c] for c in crowd.columns if c not in ("size", "repeats"))]
        assert r["size"] == size(r.text) and r.taken == r.repeats * r["size"] and r.target == pytest.approx(targets[r.source])
        assert r.hash == "hash" and r.gone == "gone" and r.key == "key"
    for k, t in targets.items():
        assert abs(sum(r.taken for r in got if r.source == k) - t) <= max([size(r.text) for r in rows if r.source == k])


def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline as cp
    from quantloom.llm.jobs import cut

    docs = table(spark, TINY, "documents")
    columns = docs.columns
    for i, (_, stage) in enumerate(cp.STAGES):
        new = cut(stage(spark, docs, TINY))
        assert 0 < new.count() <= docs.count()
        assert new.columns == columns or i == len(cp.STAGES) - 1
        docs = new
    assert docs.where("taken > 2 * size OR taken <= 0").count() == 0
    assert [len(cp.STAGES), cp.ORACLE_SQL] == [5, None]


def test_pipeline_of_no_documents(spark, crowd):
    import corpus_pipeline as cp

    for docs in (table(spark, TINY, "documents").limit(0), crowd.limit(0)):
        for _, stage in cp.STAGES:
            docs = stage(spark, docs, TINY)
            assert docs.count() == 0


# 11 manifest


def _h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def _manifest_by_hand(rows):
    """rows (doc_id, source, lang, n_chars, text) to sorted (doc_id, leaf, subroot, root, siblings)."""

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def tree(leaves):
        proofs, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
        while len(level) > 1:
            for i, p in enumerate(at):
                run = level[p // 16 * 16 : p // 16 * 16 + 16]
                proofs[i] += run[: p % 16] + run[p % 16 + 1 :]
                at[i] = p // 16
            level = [_h("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
        return level[0], proofs

    of = {}
    for r in rows:
        of.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, _h("".join(map(field, r))), r[0]))
    sources = sorted(of, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([x[2] for x in sorted(of[s])]) for s in sources]
    root, above = tree([t[0] for t in trees])
    return sorted(((x[3], x[2], trees[k][0], root, "".join(trees[k][1][i] + above[k])) for k, s in enumerate(sources) for i, x in enumerate(sorted(of[s]))), key=repr)


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [257, 1, 4097, 3], [1] * 40])
def test_manifest_by_hand(spark, sizes):
    rows = [(i, f"s{k}" if k else None, None, i, f"text {i}") for k, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    found = merkle.merkle_manifest(docs).withColumns({"all": F.array_join(F.transform("proof", lambda p: F.concat(p["left"], p["right"])), ""), "folded": merkle.folded(F.col("leaf"), F.col("proof"))}).collect()
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, r["all"]) for r in found), key=repr) == _manifest_by_hand(rows)
    assert all(r.folded == r.root for r in found)


def test_manifest_of_odd_rows(spark, odd):
    docs = odd.withColumn("n_chars", F.lit(None).cast("long"))
    found = merkle.merkle_manifest(docs, keep={"at": F.lit(3)})
    want = _manifest_by_hand([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()])
    got = [(r.doc_id, r.leaf, r.subroot, r.root, "".join(p.left + p.right for p in r.proof)) for r in found.collect()]
    assert sorted(got, key=repr) == want and found.columns[-1] == "at"
    assert merkle.merkle_manifest(docs.limit(0)).count() == 0


def test_a_changed_row_is_noticed(spark):
    found = merkle.merkle_manifest(table(spark, TINY, "documents"), keep={"other": merkle.leaf_digest(F.lit("x"))})
    rows = found.select((merkle.folded(F.col("leaf"), F.col("proof")) == F.col("root")).alias("kept"), (merkle.folded(F.col("other"), F.col("proof")) == F.col("root")).alias("changed")).collect()
    assert all(r.kept and not r.changed for r in rows)


def test_no_task_gathers_a_source(spark):
    rows = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("one").alias("source"), F.lit("leaf").alias("leaf"))
    placed = merkle.numbered(merkle.cut(rows), "source", ["doc_id", "leaf"])
    blocks = placed.groupBy(F.shiftright("pos", merkle.BLOCK_BITS).alias("b")).agg(F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).collect()
    assert len(blocks) == 10 and max(b.n for b in blocks) == 4096 and all(b.hi - b.lo + 1 == b.n for b in blocks)


# 12 Jaccard join


def _jaccard_by_hand(rows):
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        o = len(sets[i] & sets[j])
        if o and 100 * o >= 80 * (len(sets[i]) + len(sets[j]) - o):
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize(("tree_cost", "broadcast_rows"), [(1 << 18, 200_000), (1500, 1)])
def test_jaccard_components_by_hand(spark, odd, tree_cost, broadcast_rows):
    rng = np.random.default_rng(5)
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    for group in range(8):
        base = rng.integers(0, 300, 20 + 30 * group)
        for _ in range(25):
            w = base.copy()
            w[rng.integers(0, len(w), rng.integers(0, 6))] = rng.integers(0, 300)
            rows.append((len(rows) * 7 % 1009 + 100, " ".join(f"{'W' if rng.random() < 0.5 else 'w'}{x}" for x in w[: len(w) - rng.integers(0, 9)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("n", "set", "sid", "rk", "g", "label", "root", "h")}).repartition(3)
    found = jaccard_join.jaccard_components(docs, tree_cost=tree_cost, broadcast_rows=broadcast_rows)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=repr) == _jaccard_by_hand(rows)
    assert jaccard_join.jaccard_components(docs.limit(0)).count() == 0


def test_tree_links_connect_what_all_pairs_connect():
    rng = np.random.default_rng(3)
    for _ in range(300):
        base, sets = [np.unique(rng.integers(0, 400, rng.integers(3, 80))) for _ in range(rng.integers(1, 5))], {}
        for _ in range(rng.integers(2, 40)):
            s = np.unique(np.concatenate((rng.permutation(base[rng.integers(len(base))])[rng.integers(0, 6) :], rng.integers(0, 400, rng.integers(1, 5)))))
            sets[s.tobytes()] = s
        sets = list(sets.values())
        sizes = np.array([len(s) for s in sets]) + rng.integers(0, 3, len(sets))
        label = rng.integers(0, 2 * len(sets), len(sets))
        links = {(i, j) for i, j in combinations(range(len(sets)), 2) if 9 * len(np.intersect1d(sets[i], sets[j])) >= 4 * (sizes[i] + sizes[j])}
        found = jaccard_join.tree_links(np.arange(len(sets)), label, sizes, sets) if len(sets) > 1 else []
        assert {tuple(sorted(p)) for p in found} <= links

        def roots(pairs, label=label):
            now = label.copy()
            for i, j in pairs:
                now[now == now[i]] = now[j]
            return [int(np.flatnonzero(now == x)[0]) for x in now]

        assert roots(found) == roots(links)


def test_a_long_group_is_dealt_into_trees_of_bounded_size(spark, monkeypatch):
    """Two chains of near-copies in one group, whose neighbours link and whose ends don't."""
    sets = [(i, 60, list(range(2 * i, 2 * i + 60))) for i in range(150)] + [(1000 + i, 60, list(range(55 + 2 * i, 115 + 2 * i))) for i in range(0, 20)]
    told = spark.createDataFrame(sets, "sid long, n long, codes array<long>")
    want = {(a, b) for (a, n, x), (b, m, y) in combinations(sets, 2) if 9 * len(set(x) & set(y)) >= 4 * (n + m)}
    seen = []
    trees = jaccard_join._trees
    monkeypatch.setattr(jaccard_join, "_trees", lambda members: seen.append(members.groupBy("tree").count().agg(F.max("count")).first()[0]) or trees(members))
    links = jaccard_join.set_links(told, tree_cost=20 * 316)
    roots = {r.node: r.root for r in components(links).collect()}
    by_hand = {r.node: r.root for r in components(spark.createDataFrame(list(want), "a long, b long")).collect()}
    assert roots == by_hand and max(x or 0 for x in seen) < 60


# 13 periodic runs


def _runs_by_hand(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        agree = [i + q < len(w) and w[i] == w[i + q] for i in range(len(w))]
        i = 0
        while i < len(w):
            j = i
            while j < len(w) and agree[j]:
                j += 1
            if j - i + q >= max(6, 4 * q) and not any(all(w[k] == w[k + p] for k in range(i, j + q - p)) for p in range(1, q)):
                out.append((i, j - i + q, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(600):
        texts = []
        for _ in range(rng.integers(1, 5)):
            k, w = rng.integers(1, 6), []
            for _ in range(rng.integers(0, 6)):
                p = [f"{x}" for x in rng.integers(0, k, rng.integers(1, 10))]
                w += p * rng.integers(1, 7) + p[: rng.integers(0, len(p))]
            texts.append(w)
        assert periodic_runs.runs_of([" ".join(w).encode() for w in texts]) == [_runs_by_hand(w) for w in texts]


def test_equal_leading_bits_are_sorted_in_full(monkeypatch):
    monkeypatch.setattr(periodic_runs, "mix", lambda h: h & np.uint64(255))
    key = np.random.default_rng(2).integers(0, 1000, 3000).astype(np.uint64) << np.uint64(6)
    at, name, far = periodic_runs.successors(key, np.arange(3000))
    for i, n, d in zip(at.tolist(), name.tolist(), far.tolist(), strict=True):
        again = np.flatnonzero(key[i + 1 :] == key[i])
        assert d == (again[0] + 1 if len(again) else 0) and (key[at[name == n]] == key[i]).all()


def _run_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = _runs_fast(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
    told = ("".join(f"{s},{length},{q}\n" for s, length, q in runs), " ".join(x for i, x in enumerate(w) if i not in gone))
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *[hashlib.sha256(x.encode()).hexdigest() for x in told])


def _runs_fast(w):
    """As _runs_by_hand, by numpy, for long texts."""
    ids, out = {}, []
    a = np.array([ids.setdefault(x, len(ids)) for x in w])
    for q in range(1, len(w) // 4 + 1):
        edge = np.diff(np.concatenate(([0], (a[q:] == a[:-q]).view(np.int8), [0])))
        for i, j in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            if j + q - i >= max(6, 4 * q):
                s = a[i : j + q]
                if not any((s[p:] == s[:-p]).all() for p in range(1, q)):
                    out.append((i, j + q - i, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_periodic_run_query_against_brute_force(spark):
    docs = table(spark, TINY, "documents").collect()
    got = sorted(tuple(r) for r in queries.QUERIES["op13_periodic_runs"](spark, TINY).collect())
    assert got == sorted(_run_row(r.doc_id, r.text) for r in docs)
    assert sum(r[1] > 0 for r in got) > 10


def test_periodic_runs_of_odd_rows(spark, odd):
    found = periodic_runs.periodic_runs(odd)
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.text) for r in found.collect()), key=repr)
    want = []
    for d, t in ODD:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = _runs_fast(w)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        want.append((d, len(w), runs, " ".join(x for i, x in enumerate(w) if i not in gone)))
    assert got == sorted(want, key=repr) and any(r[2] for r in got)
    assert periodic_runs.periodic_runs(odd.limit(0)).count() == 0
