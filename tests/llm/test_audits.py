"""Filter interaction, decontamination and divergence against brute force, with odd rows."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from keytide.llm import audit, decontaminate, divergence, queries, text

DOC = "doc_id long, text string, lang string, source string, n_chars long, Part string"
A_Z = {i: i + 32 for i in range(65, 91)}


def bag(rows):
    return collections.Counter(tuple(r) for r in rows)


@pytest.fixture(scope="module")
def spark_(spark):
    text.ship(spark)
    return spark


def texts():
    rnd = random.Random(11)
    vocabulary = ["the", "of", "Über", "straße", "NASA", "x1", "don't", "中文", "a", "b$", "end.", "🙂", "é"]
    draw = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    plain = " ".join(f"w{i}" for i in range(80))
    out = [None, "", " \n\t\x0b", "one", plain, plain, plain + " | #", plain.upper(), draw(49), draw(50), draw(400), "é" * 3000,
           "Z" * 2000 + " " + plain, "same words " * 60, " nbsp em " * 40, plain + "\n" + plain]
    return out + [draw(rnd.randint(1, 120)) for _ in range(30)]


@pytest.fixture(scope="module")
def docs(spark_):
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None, ""][i % 4], 1, "clash") for i, t in enumerate(texts())]
    rows += [rows[4], rows[4], rows[10], (None, rows[4][1], "en", "a", 1, None), (None, None, None, None, None, None)]
    return spark_.createDataFrame(rows, DOC).repartition(3).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return docs.collect()


# -- 11 ---------------------------------------------------------------------------


def plain_counts(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return len(w), len(set(w)), len(re.findall("[A-Z]", t)), len(t), len(re.findall("[#$%&*|]", t))


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_transducer_counts_whole_texts_in_any_blocks(block):
    for t in map(lambda x: x or "", texts()):
        if block > 1 or len(t) < 3000:
            assert audit.counted(t.encode(), block) == plain_counts(t)


def plain_audit(rows, labels):
    out = {}
    masks = []
    for r in rows:
        t = r["text"] or ""
        n, distinct, capitals, points, symbols = plain_counts(t)
        fails = [n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * points, symbols > 0,
                 any(r["doc_id"] is not None and o["doc_id"] is not None and o["doc_id"] < r["doc_id"] and (o["text"] or "") == t for o in rows)]
        mine = [x for x in labels if x[0] is not None and x[0] == r["doc_id"]]
        masks.append((r["source"] or "", dict(zip("ABCDE", fails)), any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    removed = collections.Counter()
    for part in {m[0] for m in masks}:
        for order in itertools.permutations("ABCDE"):
            for i, f in enumerate(order):
                c = collections.Counter()
                for p, fails, good, toxic in masks:
                    if p != part:
                        continue
                    gone = any(fails[x] for x in order[:i])
                    c["kept"] += not gone and not fails[f]
                    c["removed"] += not gone and fails[f]
                    c["redundant"] += gone and fails[f]
                    c["unique"] += fails[f] and sum(fails.values()) == 1
                    c["good"] += not gone and fails[f] and good
                    c["toxic"] += not gone and fails[f] and toxic
                removed[part, f] += c["removed"]
                out[part, "".join(order), i + 1] = (f, [c[k] for k in ("kept", "removed", "redundant", "unique", "good", "toxic")])
    return collections.Counter((*k, *v, removed[k[0], f]) for k, (f, v) in out.items())


def test_audit_of_filters_matches_brute_force(spark_, docs, rows, tmp_path):
    labels = [(i, i % 2, i % 3 == 0 and 1 or None) for i in range(0, 40, 3)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (999, 1, 1)]
    docs.drop("Part").write.parquet(f"{tmp_path}/documents.parquet")
    spark_.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op11_audit(spark_, str(tmp_path))
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert bag(got.select(*columns).collect()) == plain_audit(rows, labels)


def test_audit_of_nothing_and_of_other_filters(spark_, docs):
    none = spark_.createDataFrame([], DOC)
    assert audit.interactions(audit.failures(none), "ABCDE", {}).count() == 0
    flags = audit.failures(docs).withColumn("part", F.lit("all"))
    got = {(r["filter_order"], r["step"]): r for r in audit.interactions(flags, ["E", "A"], {}).collect()}
    assert set(got) == {("EA", 1), ("EA", 2), ("AE", 1), ("AE", 2)}
    assert got["EA", 2]["kept"] == got["AE", 2]["kept"]
    assert got["EA", 1]["shapley"] == got["EA", 1]["removed"] + got["AE", 2]["removed"]


# -- 12 ---------------------------------------------------------------------------


def item_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(A_Z))


def plain_hits(t, items):
    w, hit, ids = item_words(t), set(), set()
    for item, body in items:
        b = item_words(body)
        k = min(10, len(b))
        grams = {tuple(b[i:i + k]) for i in range(len(b) - k + 1)} if k else set()
        for i in range(len(w) - k + 1):
            if k and tuple(w[i:i + k]) in grams:
                hit.update(range(i, i + k))
                ids |= {str(item)} if item is not None else set()
    return len(w), sorted(hit), sorted(ids)


def benchmark_items():
    rnd = random.Random(5)
    common = " ".join(f"c{i}" for i in range(14))
    out = [(i, f"Question {i}: " + common + " " + " ".join(f"i{i}x{rnd.randint(0, 9)}" for _ in range(rnd.randint(0, 40)))) for i in range(12)]
    out += [(20, None), (21, ""), (22, "-- !"), (23, "tiny one"), (24, "中文 straße"), (None, "no id at all"), (30, out[3][1].upper()),
            (2, "a second text of item two"), (31, " ".join(f"long{i % 700}" for i in range(1500))), (32, "q" * 3000 + " r")]
    return out


def contaminated(items):
    rnd = random.Random(6)
    noise = lambda n: " ".join(f"n{rnd.randint(0, 50)}" for _ in range(n))
    body = dict((k, v) for k, v in items if v)
    out = [None, "", noise(30), noise(5) + " TINY, one! " + noise(5), body[3], body[3].replace(" ", "\n--"), "x " + body[31] + " tiny-one",
           noise(40) + " " + " ".join(f"c{i}" for i in range(14)) + " " + noise(3), " ".join(f"c{i}" for i in range(9)),
           "no id AT all", "q" * 3000 + "-r", "tiny one tiny one", body[5][:70], "中文 straße 中文 strasse", "tiny", noise(200) + body[9] + noise(300)]
    return out


@pytest.mark.parametrize("block", [8 << 20, 3000])
def test_contamination_matches_brute_force(spark_, block, monkeypatch):
    monkeypatch.setattr(decontaminate, "PART", 100)
    items = benchmark_items()
    bodies = contaminated(items) + [x for _, x in items]
    docs = [(i if i != 4 else None, t, "Extra") for i, t in enumerate(bodies)] + [(7, bodies[7], None), (7, bodies[7], "again")]
    df = spark_.createDataFrame(docs, "doc_id long, text string, Runs2 string").repartition(3)
    found = decontaminate.report(df, spark_.createDataFrame(items, "item_id long, text string").repartition(2), block=block)
    want = collections.Counter()
    for doc, t, _ in docs:
        n, hit, ids = plain_hits(t, items)
        want[doc, n, len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest()] += 1
    assert bag(found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256").collect()) == want
    assert any(k[2] for k in want) and any(not k[2] for k in want)


@pytest.mark.parametrize("piece", [5, 64, 1 << 19])
def test_scan_in_any_pieces(piece):
    items = [(k, v) for k, v in benchmark_items() if v]
    table, _, _ = decontaminate.table_of([decontaminate.normal(v.encode()) for _, v in items])
    for t in contaminated(benchmark_items()):
        marked, _ = decontaminate.scan((t or "").encode(), table, piece=piece)
        assert np.flatnonzero(marked).tolist() == plain_hits(t, items)[1]


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    windows = decontaminate.Words.windows
    monkeypatch.setattr(decontaminate.Words, "windows", lambda self, k: (windows(self, k)[0] % np.uint64(3), *windows(self, k)[1:]))
    bodies = [" ".join(f"{c}{i}" for i in range(25)).encode() for c in "abcd"] + [b"one two", b"two one"]
    table, group, item = decontaminate.table_of(bodies)
    assert sorted(item.tolist()) == list(range(6)) and len(set(group.tolist())) == 6
    marked, groups = decontaminate.scan(b"zz one two yy " + bodies[2] + b" two", table)
    assert np.flatnonzero(marked).tolist() == [1, 2, *range(4, 29)]
    assert {int(i) for g, i in zip(group, item) if g in groups} == {2, 4}


def test_spans_go_and_the_rest_stays(spark_):
    items = spark_.createDataFrame([(1, "one two three four"), (2, " ".join(f"k{i}" for i in range(12)))], "item_id long, text string")
    rows = [(1, "Before: (one, TWO three\nfour) after é.", 40), (2, "clean text", 9), (3, None, None), (4, "one two three four", 18),
            (5, "A " + " ".join(f"k{i}" for i in range(11)) + "! B", 5)]
    df = spark_.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in decontaminate.cleaned(df, items).collect()}
    assert got == {1: ("Before: () after é.", 19), 2: ("clean text", 10), 3: (None, 0), 4: ("", 0), 5: ("A ! B", 5)}
    whole = decontaminate.cleaned(df, items, "documents")
    assert whole.columns == df.columns and {r["doc_id"] for r in whole.collect()} == {2, 3}
    none = items.limit(0)
    assert {r["n_hit"] for r in decontaminate.report(df, none).collect()} == {0}
    assert decontaminate.report(df.limit(0), items).count() == 0
    with pytest.raises(ValueError):
        decontaminate.cleaned(df, items, "lines")
    with pytest.raises(ValueError):
        decontaminate.cleaned(df.withColumn("RUNS", F.lit(1)), items)


# -- 13 ---------------------------------------------------------------------------


def plain_divergence(rows, least, top):
    words = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(A_Z))
    groups, df, of_lang = collections.defaultdict(collections.Counter), collections.Counter(), collections.defaultdict(collections.Counter)
    for r in rows:
        lang, source, w = r["lang"] or "", r["source"] or "", words(r["text"])
        groups[lang, source].update(w)
        of_lang[lang].update(w)
        df.update((lang, x) for x in set(w))
    kept = {lang: sorted(x for x in c if df[lang, x] >= least) for lang, c in of_lang.items()}
    shares = lambda c, k: {x: 1 + 10**9 * (c[x] + 5) // (sum(c[y] for y in k) + 5 * len(k)) for x in k}
    out = collections.Counter()
    for (lang, source), c in groups.items():
        p, q = shares(c, kept[lang]), shares(of_lang[lang], kept[lang])
        pairs = [(-sum(abs(p[x] - o[x]) for x in p), s.encode(), s) for (at, s), d in groups.items()
                 if at == lang and s != source for o in [shares(d, kept[lang])]]
        terms = [(q[x] - p[x], x.encode(), x) for x in p if c[x] and p[x] > q[x]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out.update((lang, source, part, x, -v, i + 1) for i, (v, _, x) in enumerate(found))
    return out


@pytest.mark.parametrize("least,top,block,cells", [(3, 5, 300_000, 1 << 21), (2, 50, 40, 8), (1, 3, 7, 1), (10**6, 5, 100, 100)])
def test_divergence_matches_brute_force(docs, rows, least, top, block, cells):
    got = divergence.audit(docs.repartition(2), least, top, block, cells)
    assert bag(got.select("lang", "source", "part", "item", "value", "rank").collect()) == plain_divergence(rows, least, top)


def test_terms_in_pieces_and_wide_shares(docs):
    body = ("Straße " * 50 + "x" * 300 + " ÀB1c" * 40).encode()
    whole = [w for part in divergence.terms(body) for w in part]
    for piece in (1, 3, 64):
        assert [w for part in divergence.terms(body, piece) for w in part] == whole
    counts = np.array([0, 1, 10**12, 8 * 10**13], np.int64)
    n = np.full(4, 9 * 10**13, np.int64)
    assert divergence.shares(counts, n, 1000).tolist() == [1 + 10**9 * (int(c) + 5) // (int(n[0]) + 5000) for c in counts]
    assert divergence.audit(docs.limit(0)).count() == 0
