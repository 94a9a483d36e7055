"""Operators for training data against brute force, with odd rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece  # noqa: F401
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from keytide.llm import chat, components, embedding, mixing, nbest, quality, queries, sharding, simhash, suffix, text, tokens, toxicity

GAPS = " \t\n\x0b\f\r"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def words(t):
    return [w for w in re.split("[ \t\n\x0b\f\r]+", t or "") if w]


def odd_texts():
    rnd = random.Random(7)
    syllables = ["th", "in", "er", "re", "on", "an", "ou", "ti", "é", "ß"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))
    base = " ".join(word() for _ in range(300)) + "."
    passage = " ".join(word() for _ in range(120))
    texts = [None, "", " \n\t", "one", "a b c d", "A B C D", base, base, base.replace("th", "ht", 1), base + " more",
             "x\ty\x0bz\n" * 30, "same line here.\n" * 12, "w " * 900, "ab" * 700, "é" * 500, "y" * 399, "y" * 400,
             "<s> </s> <unk> ▁ 中🙂\n", "it |  is | a | bar |\nGood words end well here.\n" * 3]
    for i in range(8):
        texts.append(" ".join(word() for _ in range(60)) + ". " + passage + " " + " ".join(word() for _ in range(40)) + f" {i}.")
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    text.ship(spark)
    rows = [(i, t, "en", ["a", "b", None, "é"][i % 4], len(t or "")) for i, t in enumerate(odd_texts())]
    rows += [rows[6], rows[6], (None, "no id here at all", "en", "a", 17), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOC).repartition(3).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return docs.collect()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


def bag(items):
    return collections.Counter(tuple(x) for x in items)


# -- 1 ----------------------------------------------------------------------------


def test_sharding_is_even_and_gapless(spark, tmp_path):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 97 * 10 + 1).alias("size"))
    df = df.union(spark.range(1700).select(F.lit(None).cast("long"), F.lit(100).cast("long")))  # a hot key
    rows = sharding.with_ordinal(df)
    rows = rows.withColumn("vslot", sharding.vslot(rows.columns, 512))
    first = sharding.first_map(sharding.slot_sizes(rows, "size", 512), 8)
    sharding.save_map(first, f"{tmp_path}/m", 0)
    old = sharding.load_map(spark, f"{tmp_path}/m", 0)
    sharding.save_map(sharding.rebalanced(old, 8), f"{tmp_path}/m", 1)
    new = sharding.load_map(spark, f"{tmp_path}/m", 1)
    with pytest.raises(Exception, match="exist"):
        sharding.save_map(old, f"{tmp_path}/m", 1)
    placed = sharding.place(rows, new, ["doc_id", "size", "ordinal"]).collect()
    assert len(placed) == 6700
    sizes, slots = collections.Counter(), collections.defaultdict(list)
    for r in placed:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert max(sizes.values()) - min(sizes.values()) < 0.01 * sum(sizes.values()) / 8
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    grown = sharding.rebalanced(new, 9)
    assert {r["shard"] for r in grown.select("shard").distinct().collect()} == set(range(9))
    to = [r["shard"] for r in sharding.moves(new, grown).select("shard").collect()]
    assert len(to) < 512 / 4 and to.count(8) > 0.7 * len(to)  # an edit, not a new deal
    empty = df.limit(0).withColumn("vslot", F.lit(0))
    sizes = sharding.slot_sizes(empty, "size", 16)
    assert sharding.rebalanced(sharding.first_map(sizes, 4), 4).count() == 16
    assert sharding.place(empty, sharding.first_map(sizes, 4), ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        sharding.place(rows.withColumn("slot", F.lit(1)), new, ["doc_id"])


def test_sharding_query_digests(spark, docs, rows, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op1_sharding(spark, str(tmp_path)).collect()
    want = bag((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in rows)
    assert bag((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}


# -- 2 ----------------------------------------------------------------------------


def plain_fingerprint(t):
    w = words((t or "").translate({i: i + 32 for i in range(65, 91)}))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def plain_components(items, linked):
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(items))]


def test_simhash_matches_all_pairs(docs, rows):
    prints = [plain_fingerprint(r["text"]) for r in rows]
    roots = plain_components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for r, c in zip(rows, roots):
        if r["doc_id"] is not None:
            least[c] = min(least.get(c, r["doc_id"]), r["doc_id"])
    want = bag((r["doc_id"], p, least.get(c)) for r, p, c in zip(rows, prints, roots))
    got = simhash.near_duplicates(docs).collect()
    assert bag((r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in got) == want


@pytest.mark.parametrize("block", [4096, 5])
def test_fingerprint_links_lose_nothing(spark, block):
    rnd = random.Random(3)
    base = [rnd.getrandbits(64) for _ in range(60)]
    fps = set(base)
    for b in base:
        for _ in range(6):
            x = b
            for bit in rnd.sample(range(64), rnd.randint(1, 5)):
                x ^= 1 << bit
            fps.add(x)
    fps = sorted(np.array(sorted(fps), dtype=np.uint64).view(np.int64).tolist())
    links = simhash.fingerprint_links(spark.createDataFrame([(f,) for f in fps], "fp long"), block)
    found = {r["node"]: r["component"] for r in components.components(links).collect()}
    roots = plain_components(fps, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 4)
    assert [found.get(f, f) for f in fps] == [fps[c] for c in roots]


def test_simhash_empty_and_dedup(docs, none, rows):
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(None) == 1 and ids.count(6) == 1 and 7 not in ids  # the NULL text is a copy of the empty ones


def test_one_row_of_every_group_stays_whatever_its_id(spark):
    a, b = ("one text of a few plain words", "quite another text, with other words in it")
    rows = [(1, a, "x"), (1, b, "y"), (2, a, "z"), (None, "no id, first of its kind", "u"), (None, "no id, first of its kind", "v"),
            (None, b, "w"), (7, b, "q"), (1, a, "x")]
    found = set()
    for n in (1, 3, 5):
        df = spark.createDataFrame(rows[n:] + rows[:n], "doc_id long, text string, Source string").repartition(n)
        kept = simhash.deduplicated(df)
        assert kept.columns == df.columns
        found.add(tuple(sorted(map(str, kept.collect()))))
        assert collections.Counter(r["text"] for r in kept.collect()) == {a: 1, b: 1, "no id, first of its kind": 1}
        assert [r["doc_id"] for r in kept.filter(F.col("text") == b).collect()] == [1]
    assert len(found) == 1


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (None, 3), (700, 701)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(links.repartition(7)).collect()}
    assert got == {i: 0 for i in range(201)} | {700: 700, 701: 700}
    assert components.components(links.limit(0)).count() == 0


# -- 3 ----------------------------------------------------------------------------


def test_embedding_join_matches_all_pairs(spark):
    rng = np.random.default_rng(5)
    rows, centres = [], rng.normal(size=(12, 16))
    for i in range(240):
        v = centres[i % 12] + rng.normal(size=16) * rng.choice([0.02, 0.15])
        rows.append((i, [float(np.float32(x)) for x in v * rng.uniform(0.5, 3)], i % 3))
    rows += [(300 + i, rows[0][1], 0) for i in range(30)]
    rows += [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] * 16, 1), (403, rows[0][1], None),
             (404, [None] + rows[1][1][1:], 1), (405, [], 1), (406, rows[0][1][:8], 0), (407, [float("inf")] * 16, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    text.ship(spark)
    good = [(i, np.array(v, np.float32).astype(float), g) for i, v, g in rows if i < 400]
    cos = lambda a, b: a[2] == b[2] and a[1] @ b[1] / np.sqrt((a[1] @ a[1]) * (b[1] @ b[1])) >= 0.98
    roots = plain_components(good, cos)
    n = [sum(cos(a, b) for b in good) - 1 for a in good]
    want = {g[0]: (k, good[c][0]) for g, k, c in zip(good, n, roots)} | {i: (0, i) for i, _, _ in rows if i >= 400}
    for interval in (512, 7):
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding.near_duplicates(df, interval=interval).collect()}
        assert got == want
    assert embedding.near_duplicates(df.limit(0)).count() == 0


# -- 4 ----------------------------------------------------------------------------


def small_model():
    rng = np.random.default_rng(2)
    return chat.Hmm(rng.integers(0, 9, chat.N), rng.integers(0, 9, (chat.N, chat.N)),
                    [rng.integers(0, 9, (chat.N, k)) for k in chat.SIZES])


def test_viterbi_is_the_best_of_all_paths_whole_or_in_parts():
    model, rnd = small_model(), random.Random(4)
    for _ in range(6):
        shown = [tuple(rnd.randrange(k) for k in chat.SIZES) for _ in range(5)]
        seen = model.seen(shown)

        def score(path):
            total = model.start[path[0]] + seen[0][path[0]]
            for i in range(1, len(path)):
                total += model.moves[path[i - 1], path[i]] + seen[i][path[i]]
            return total

        every = np.array(np.meshgrid(*[range(chat.N)] * 5)).reshape(5, -1).T
        best = max(score(p) for p in every)
        parts = [shown[:2], shown[2:3], shown[3:]]
        path = []
        for part, (before, last) in zip(parts, chat.borders([model.reduced(p) for p in parts])):
            path += model.decode(part, before, last)
        assert score(path) == pytest.approx(best)


def test_chat_query(spark, tmp_path):
    turns = []
    for c in range(60):
        for t in range(6):
            role = "user" if t % 2 == 0 else "assistant"
            turns.append((c, t, role, f"What about {c} and {t}?" if role == "user" else f"Well, {c} is {t}.\nThat is all there is to it."))
    turns += [(70, t, "user" if t % 2 == 0 else "assistant", f"line {t}") for t in range(700)]  # several parts
    turns += [(80, 0, None, None), (81, None, "user", "hello"), (None, 0, "user", "hi"), turns[0]]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op4_chat(spark, str(tmp_path)).collect()
    n = sum(r["n_lines"] for r in got)
    assert sum(r["n_right"] for r in got) > 0.85 * n
    assert sorted(r["part"] for r in got if r["conv_id"] == 70) == [0, 1, 2]
    assert [(r["n_lines"], r["n_turns"]) for r in got if r["conv_id"] == 80] == [(0, 0)]
    assert chat.canonical([("user", "a")]) == "<|user|>\na\n<|end|>\n"
    assert chat.lines_of("Q: why?\n\n[assistant] so.", True) == [("why?", (2, 0, 0, 1, 1)), ("so.", (3, 1, 0, 2, 0))]


def test_chat_roles_stand_beside_their_lines(spark):
    """Blank lines of any white space: the same lines count in Spark and in Python."""
    gaps = [chr(i) for i in range(0x110000) if chr(i).isspace()]
    said = ["User: a\r\n\r\nb", "\t\nAssistant: c\n \t ", *(f"{g}\n{g}d" for g in gaps), "\u200b\n\ufeff\n\x00", "end"]
    rows = [(1, i, ["user", "assistant"][i % 2], t) for i, t in enumerate(said)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    part = chat.parts(df, F.col("text")).first()
    want = [r for _, _, r, t in rows for line in t.split("\n") if line.strip()]
    assert part["roles"] == want and len(chat.lines_of(part["transcript"], True)) == len(want)


# -- 5 and 8 ----------------------------------------------------------------------


def test_token_counts_match_the_library(docs, rows, none):
    p = tokens.processor()
    want = bag((r["doc_id"], len((r["text"] or "").encode()), len(p.encode(r["text"] or ""))) for r in rows)
    for head in (tokens.HEAD, 0):
        got = tokens.counts(docs, head=head).collect()
        assert bag((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert tokens.counts(none).count() == 0


def all_segmentations(lattice, word):
    out = []

    def go(at, score, ids):
        if at == len(word):
            out.append((score, ids))
            return
        single = False
        for end in range(at + 1, len(word) + 1):
            found = lattice.pieces.get(word[at:end])
            if found:
                single |= end == at + 1
                go(end, score + found[1], ids + (found[0],))
        if not single:
            go(at + 1, score + lattice.unknown, ids + tuple(lattice.bytes[b] for b in word[at].encode()))

    go(0, 0, ())
    return sorted(out, key=lambda x: -x[0])


@pytest.mark.parametrize("t", ["the cat", "of  a é\n中", "thndo in", " ", "x\n", "▁a"])
def test_n_best_are_the_best_of_all(t):
    lattice = nbest.Lattice()
    every = all_segmentations(lattice, (" " + t).replace(" ", "▁"))
    for n in (1, 2, 6):
        found = lattice.text(t, n)
        assert [s for s, _ in found] == [s for s, _ in every[:n]]
        assert len({ids for _, ids in found}) == len(found) and {ids for _, ids in found} <= {ids for _, ids in every}


def test_encoding_round_trip(docs, rows, none):
    got = nbest.encode(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["text"] is None:
            assert (r["ids"], r["back"]) == (None, None)
        else:
            assert r["back"] and nbest.decode(r["ids"]) == r["text"].replace("▁", " ")
    assert nbest.encode(none).count() == 0 and nbest.digests(none).count() == 0
    assert all(r["round_trip"] for r in nbest.digests(docs).collect())
    with pytest.raises(ValueError):
        nbest.encode(docs.withColumn("ids", F.lit(1)))


@pytest.mark.parametrize("t", ["the cat", "of  a é\n中", "thndo in", " ", "x\n", "▁a", "unbelievably 12345 ~~~"])
def test_kept_gap_is_that_of_the_second_best(t):
    lattice = nbest.Lattice()
    for word in {w.replace(" ", "▁") for w in tokens.pretokens(t)}:
        ways = lattice.search(word, 2)
        gap = ways[0][0] - ways[1][0] if len(ways) > 1 else nbest._NO_GAP
        assert lattice.first(word) == (*ways[0], gap)


def test_pre_tokens_searched_side_by_side_are_those_searched_alone(monkeypatch):
    rng, lattice = random.Random(8), nbest.Lattice()
    letters = " aeinrstthe.,!0123\u2581\u00e9\u4e16\u754c\U0001f600\x07"
    words = sorted({"".join(rng.choices(letters, k=rng.randrange(1, 14))) for _ in range(600)} | {" " * 90, "the" * 33})
    want = []
    for word in words:
        score, ids, gap = lattice.first(word.replace(" ", "\u2581"))
        want.append((score, nbest._packed(ids), gap))
    assert lattice.firsts(words) == want and lattice.firsts(words[5:6]) == want[5:6]
    long = "x\u00e9" * 200
    monkeypatch.setattr(nbest, "_GROUP", 5)
    found = list(nbest._looked_up(lattice, ["a b", None, "", long, "the the"], 1))
    assert [w if w is None else [len(w), w[0][0]] for _, w in found] == [
        None if t is None else [1, lattice.text(t, 1)[0][0]] for t in ["a b", None, "", long, "the the"]]
    monkeypatch.setattr(lattice, "first", None)  # only long ones are searched alone
    lattice.forget(1)
    assert len(next(lattice.ways(["the end of the lattice"], 1))) == 1



def test_every_one_of_the_n_best_is_written_out_and_decoded(spark):
    texts = ["the cat sat on the mat", "of  a é\n中", "", None, "▁a b", "x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    lattice = nbest.Lattice()
    want = {i: None if t is None else lattice.text(t) for i, t in enumerate(texts)}
    for r in nbest.encode(docs, every=True).collect():
        if (ways := want[r["doc_id"]]) is None:
            assert (r["nbest"], r["decoded"]) == (None, None)
            continue
        assert [tuple(x) for x in r["nbest"]] == [ids for _, ids in ways] and r["scores"] == [s for s, _ in ways]
        assert r["ids"] == r["nbest"][0] and r["decoded"] == [r["text"].replace("▁", " ")] * len(ways)
    for r in nbest.digests(docs).collect():
        if (ways := want[r["doc_id"]]) is None:
            assert (r["nbest_crc32"], r["decoded_crc32"], r["n_pieces"]) == (None, None, 0)
            continue
        crcs = [zlib.crc32(np.array(ids, "<i4").tobytes()) for _, ids in ways]
        assert r["nbest_crc32"] == crcs and r["ids_crc32"] == crcs[0] and r["n_pieces"] == len(ways[0][1]) and r["round_trip"]
        assert r["decoded_crc32"] == [zlib.crc32(texts[r["doc_id"]].replace("▁", " ").encode())] * len(ways)


def _batch_sizes(spark):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    return [r["n"] for r in spark.range(5000).coalesce(1).mapInArrow(run, "n long").collect()]


@pytest.mark.parametrize("step", ["simhash_stage", "suffix_stage", "encoding_stage", "op6"])
def test_python_steps_over_texts_take_few_rows_at_once(spark, step):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5), (2, "d e", "en", "s", 3)], DOC)
    try:
        spark.conf.set(name, "10000")
        if step == "op6":
            toxicity.scores(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"), F.lit(True)).count()
        else:
            getattr(corpus_pipeline, step)(spark, docs, "").count()
        assert max(_batch_sizes(spark)) <= 1000 and sum(_batch_sizes(spark)) == 5000
        spark.conf.set(name, "7")
        text.few_rows(spark)
        assert max(_batch_sizes(spark)) == 7
    finally:
        spark.conf.set(name, before)


# -- 6 ----------------------------------------------------------------------------


def test_toxicity_on_held_out_texts(spark):
    rnd = random.Random(1)
    plain = ["".join(rnd.choice(["th", "er", "on", "an", "re"]) for _ in range(3)) for _ in range(200)]
    rows, labels = [], []
    for i in range(600):
        w = [rnd.choice(plain) for _ in range(60)]
        toxic = int(i % 6 == 0)
        if toxic:
            for _ in range(4):
                w[rnd.randrange(60)] = "vequ" + rnd.choice(["mo", "ta", "ri", "zu", "el"])
        rows.append((i, " ".join(w)))
        labels.append((i, toxic))
    rows += [(1000, None), (1001, ""), (None, "text"), rows[5]]
    labels += [(2, None), (3, 7), (None, 1), (5000, 1)]
    text.ship(spark)
    df, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    got = toxicity.scores(df, known, ~held).withColumn("held", held).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    test = [r for r in got if r["held"] and r["doc_id"] < 600]
    assert sum((r["score"] >= 0.5) == (r["doc_id"] % 6 == 0) for r in test) >= 0.97 * len(test)
    assert next(r["score"] for r in got if r["doc_id"] == 1001) < 0.5
    assert {r["score"] for r in toxicity.scores(df, known.limit(0), ~held).collect()} == {0.5}
    assert toxicity.scores(df.limit(0), known, ~held).count() == 0


_BITS = 5  # of a symbol in the codes of Models


class Models:
    """Log ratios of all grams over 32 symbols from the counts of both classes, in one dense
    table: what the operator's tables are held against.

    ``code``: grams seen; ``counts``: rows ordinary, toxic."""

    def __init__(self, code: np.ndarray, counts: np.ndarray, order: int = toxicity.ORDER, discount: float = toxicity.DISCOUNT):
        size = 1 << _BITS
        lower = np.full(size, 1.0 / size)
        for k in range(1, order):  # shared model of k symbols, by continuation counts
            seen = np.unique(code & ((1 << _BITS * (k + 1)) - 1))
            cont = np.bincount(seen & ((1 << _BITS * k) - 1), minlength=1 << _BITS * k).astype(np.float64)
            rows = cont.reshape(-1, size)
            total = rows.sum(axis=1, keepdims=True)
            kinds = (rows > 0).sum(axis=1, keepdims=True)
            # the context without its first symbol: rows of the lower model repeat
            back = np.tile(lower.reshape(-1, size), (max(1, rows.shape[0] // max(1, lower.size // size)), 1)) if k > 1 else lower.reshape(1, size)
            with np.errstate(divide="ignore", invalid="ignore"):
                p = np.maximum(rows - discount, 0) / total + discount * kinds / total * back
            lower = np.where(total > 0, p, back).ravel()
        # what a class leaves to the shared model, by context
        context = code >> _BITS
        n = 1 << _BITS * (order - 1)
        self.low = np.zeros(n, np.float32)
        share = []
        for c, sign in zip(counts, (-1, 1)):
            total = np.bincount(context, weights=c, minlength=n)
            kinds = np.bincount(context, weights=c > 0, minlength=n)
            with np.errstate(divide="ignore", invalid="ignore"):
                left = np.where(total > 0, discount * kinds / total, 1.0)
                own = np.maximum(c - discount, 0) / np.maximum(total[context], 1)
            self.low += (sign * np.log(left)).astype(np.float32)
            share.append(own + left[context] * lower[code & (n - 1)])
        self.code = code
        self.ratio = (np.log(share[1]) - np.log(share[0])).astype(np.float32)

    def dense(self) -> np.ndarray:
        """Log ratios of all grams; those never seen have the ratio of what is left to them."""
        table = np.repeat(self.low, 1 << _BITS)
        table[self.code] = self.ratio
        return table


def test_models_are_distributions():
    rng = np.random.default_rng(1)
    code = np.unique(rng.integers(0, 1 << 20, 4000)).astype(np.int32)
    counts = rng.integers(0, 5, (2, len(code))).astype(float) + [[0.0], [1.0]]
    m = Models(code, counts)
    assert np.isfinite(m.dense()).all()
    # a class that has seen nothing of a context keeps the shared model, so ratios there are the other's
    assert m.dense().shape == (1 << 20,)


def test_toxicity_in_other_scripts_and_of_long_words(spark):
    """A toxic word differs from harmless ones of its length by its letters only, in any script;
    long words of the same grams differ as wholes."""
    rnd = random.Random(3)
    text.ship(spark)
    for plain, bad in (
        (["дом", "лес", "мир", "сад"], "гад"), (["猫在", "天气", "今日", "山水"], "坏蛋"),
        (["abababab", "abababababab"], "ababababab"),
    ):
        rows, labels = [], []
        for i in range(300):
            w = [rnd.choice(plain) for _ in range(30)]
            if i % 5 == 0:
                w[3] = w[17] = bad
            rows.append((i, " ".join(w)))
            labels.append((i, int(i % 5 == 0)))
        df, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
        got = toxicity.scores(df, known, F.col("doc_id") % 3 != 0).filter("doc_id % 3 = 0").collect()
        assert sum((r["score"] >= 0.5) == (r["doc_id"] % 5 == 0) for r in got) >= 0.97 * len(got)


def test_toxicity_when_a_half_lacks_a_class(spark):
    """All toxic labels fall into one half of the calibration."""
    rnd = random.Random(9)
    text.ship(spark)
    half = lambda i: zlib.crc32(str(i).encode()) % 5
    rows, labels = [], []
    for i in range(400):
        toxic = int(i % 4 == 0 and half(i) not in (0, 2, 4))
        words_of = [rnd.choice(["ther", "oner", "anth", "reon"]) for _ in range(30)] + ["vequmo"] * 3 * toxic
        rows.append((i, " ".join(words_of)))
        labels.append((i, toxic))
    rows += [(i, "ther oner vequmo anth vequmo reon vequmo") for i in range(1000, 1004)]
    df, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.scores(df, known, F.lit(True)).collect()}
    assert all(got[i] >= 0.5 for i in range(1000, 1004))
    assert sum((got[i] >= 0.5) == t for i, t in labels) >= 0.97 * len(labels)


def test_toxicity_does_not_depend_on_what_is_broadcast(spark, monkeypatch):
    """Units found by the join and by the bit table, in many small blocks, give the scores of those in the head."""
    rnd = random.Random(4)
    text.ship(spark)
    letters = "abcdefghéßдо猫𝒳"
    rows = [(i, " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(1, 7))) for _ in range(60))) for i in range(120)]
    rows += [(500, None), (501, ""), (None, rows[3][1])]
    labels = [(i, int(i % 4 == 0)) for i in range(0, 120, 2)]
    df, known = spark.createDataFrame(rows, "doc_id long, text string").repartition(6), spark.createDataFrame(labels, "doc_id long, toxic int")
    want = bag((r["doc_id"], r["score"]) for r in toxicity.scores(df, known, F.lit(True)).collect())
    monkeypatch.setattr(toxicity, "HEAD", 40)
    assert bag((r["doc_id"], r["score"]) for r in toxicity.scores(df, known, F.lit(True)).collect()) == want


def test_log_ratios_match_the_dense_models(spark):
    rnd = random.Random(5)
    grams = sorted({"".join(rnd.choice("abcde") for _ in range(4)) for _ in range(300)})
    counts = [[rnd.choice([0, 0, 1, 3]) for _ in range(4)] for _ in grams]
    table = spark.createDataFrame([(False, g, *c) for g, c in zip(grams, counts)] + [(True, "abc", 1, 2, 0, 0), (True, "abd", 3, 0, 0, 0), (True, "new", 0, 0, 0, 0)],
                                  "word boolean, unit string, n0 long, n1 long, n2 long, n3 long")
    code = np.array([sum((ord(x) - 96) << 5 * (3 - k) for k, x in enumerate(g)) for g in grams], np.int32)
    got = {r["unit"]: r for r in toxicity.log_ratios(table, 32).collect()}
    assert got["new"]["whole"] == 0 and got["abc"]["whole"] > 0
    n = np.array(counts, float).T
    for model, sides in (("whole", n[:2] + n[2:]), ("first", n[:2]), ("second", n[2:])):
        seen = sides.sum(axis=0) > 0
        dense = Models(code[seen], sides[:, seen]).dense()
        assert np.allclose([got[g][model] for g in grams], dense[code], atol=1e-4)
    low = {r["unit"]: r for r in toxicity.context_ratios(table.withColumn("blocks", F.lit(1))).collect()}
    assert set(low) == {g[:3] for g in grams}
    for model, sides in (("whole", n[:2] + n[2:]), ("first", n[:2]), ("second", n[2:])):
        seen = sides.sum(axis=0) > 0
        m = Models(code[seen], sides[:, seen])
        assert np.allclose([low[g[:3]][model] for g in grams], m.low[code >> _BITS], atol=1e-4)


def test_grams_of_many_characters_are_exact():
    points = np.concatenate([np.arange(1, 70000), [5, 6, 7, 8, 9]]).astype(np.uint32)
    at, number = toxicity.distinct(points)
    # three grams stand over the seam, the last two are those of places 7 and 8
    assert len(at) == 69999 and number[-1] == number[8] and number[-2] == number[7]


def test_features_of_a_block_need_no_sort(monkeypatch):
    def refused(*_, **__):
        raise AssertionError("sorted")

    for name in ("argsort", "lexsort", "unique"):
        monkeypatch.setattr(np, name, refused)
    rng = random.Random(6)
    texts = [None, "", "...", "a", *("".join(rng.choices("abc.\u00e9 \n", k=rng.randrange(60))) for _ in range(40))]
    joined, points, starts, ends = toxicity.laid(texts)
    at, number = toxicity.distinct(points)
    grams = [joined[i - 3 : i + 1] for i in range(3, len(joined))]
    assert [joined[i - 3 : i + 1] for i in at.tolist()] == sorted(set(grams))
    assert [sorted(set(grams))[i] for i in number[3:].tolist()] == grams
    names, word, first, last = toxicity._words(joined, points)
    assert [names[i] for i in word.tolist()] == [w.strip(".") or w for w in joined.split()]
    assert [joined[a : b + 1] for a, b in zip(first.tolist(), last.tolist())] == joined.split()
    whole = np.array([rng.randrange(-9, 9) for _ in word], float)  # equal ones among them
    got = toxicity._features(np.zeros(len(points)), whole, starts, ends, first, last)
    for row, a, b in zip(got, starts, ends):
        mine = [(v, e - s + 2) for v, s, e in zip(whole, first, last) if a <= s < b]
        top = sorted((v / np.sqrt(n) for v, n in mine), reverse=True)[: toxicity.TOP_WORDS]
        assert np.allclose(row, [sum(v for v, _ in mine) / max(b - a, 1), sum(top) / toxicity.TOP_WORDS])


# -- 7 ----------------------------------------------------------------------------


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total >= 3 * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            open_.discard(s)
        left = sum(sizes.values()) - sum(target.values())
    return target


def test_targets_share_the_excess(spark):
    rnd = random.Random(9)
    for sizes in ({"a": 10, "b": 1000, None: 3, "é": 0}, {"a": 5}, {"a": 0}, {chr(97 + i): rnd.randint(1, 500) for i in range(12)}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
        assert got == pytest.approx(plain_targets(sizes))


def test_mixing_takes_near_targets(spark, docs, rows, none):
    many = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 13 + 1).cast("int")).alias("text"), F.lit("en").alias("lang"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"), F.lit(1).cast("long").alias("n_chars"),
    )
    got = mixing.queue(many).collect()
    assert bag(r[:] for r in got) == bag(r[:] for r in mixing.queue(many.repartition(5)).collect())
    by = collections.defaultdict(lambda: [0, 0.0])
    for r in got:
        assert r["taken"] <= 3 * r["size"] and r["taken"] == r["times"] * r["size"]
        by[r["source"]][0] += r["taken"]
        by[r["source"]][1] = r["target"]
    assert all(abs(t - want) <= 13 for t, want in by.values())
    assert sum(t for t, _ in by.values()) <= sum(r["size"] for r in got)
    small = mixing.queue(docs).collect()
    assert bag((r["doc_id"], r["size"]) for r in small) == bag((r["doc_id"], len(words(r["text"]))) for r in rows)
    assert mixing.queue(none).count() == 0 and mixing.mix(none).count() == 0
    mixed = mixing.mix(many)
    assert mixed.columns == many.columns
    counted = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert counted == collections.Counter({r["doc_id"]: r["times"] for r in got if r["times"]})


# -- 9 ----------------------------------------------------------------------------


def plain_measures(t):
    t = t or ""
    w, lines = words(t), [x for x in t.split("\n") if words(x)]
    seen, covered = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7)), set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i:i + 8])] > 1:
            covered |= set(range(i, i + 8))
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), failed)


def test_quality_measures(docs, rows, none):
    got = quality.measures(docs).collect()
    key = lambda r: (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
    assert bag(map(key, got)) == bag((r["doc_id"], *plain_measures(r["text"])) for r in rows)
    assert not any(r["kept"] for r in got if r["base_failed"])
    assert quality.measures(none).count() == 0


def test_line_rules(spark):
    good = "Plain words that end in a full stop are kept by every rule."
    bad = ["no end mark in this line of words", "ALL!! OF!! THIS!! SHOUTS!!", "home | news | about | shop.", "Home.",
           "All rights reserved.", "a### b$$$ c%%% d&&&."]
    t = "\n".join([good, *bad, good, "And a second good line, which stands here once."])
    out = quality.measures(spark.createDataFrame([(1, t)], "doc_id long, text string")).first()
    assert out["cleaned"] == good + "\nAnd a second good line, which stands here once."
    keep = "\n".join(f"Line {i} has {i}a {i}b {i}c {i}d words in it, and an end." for i in range(9))
    df = spark.createDataFrame([(1, keep, 5, 7), (2, "bar | " * 60, 5, 7)], "doc_id long, text string, n_chars long, kept0 int")
    kept = quality.clean(df).collect()
    assert [(r["doc_id"], r["text"], r["n_chars"], r["kept0"]) for r in kept] == [(1, keep, len(keep), 7)]


# -- 10 ---------------------------------------------------------------------------


def plain_removal(texts, length):
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mark = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                mark[i:i + length] = b"\1" * length
        runs = sum(1 for i in range(len(mark)) if mark[i] and (i == 0 or not mark[i - 1]))
        out.append((len(t), sum(mark), runs, hashlib.sha256(bytes(x for x, m in zip(t, mark) if not m)).hexdigest()))
    return out


@pytest.mark.parametrize("max_pieces", [suffix.MAX_PIECES, 1])
def test_repeated_passages(docs, rows, max_pieces):
    want = plain_removal([(r["text"] or "").encode() for r in rows], 400)
    got = suffix.removed(docs, max_pieces=max_pieces).collect()
    assert bag(r[:5] for r in got) == bag((r["doc_id"], *w) for r, w in zip(rows, want))
    whole = {r["doc_id"]: r["text"] or "" for r in rows}
    for r in (r for r in got if r["doc_id"] is not None):
        assert r["text"] == whole[r["doc_id"]] if not r["n_removed"] else len(r["text"].encode()) <= r["n_bytes"] - r["n_removed"]
        if hashlib.sha256(r["text"].encode()).hexdigest() != r["kept_sha256"]:
            assert r["n_removed"]  # a span cut a character


def test_short_passages_with_many_hits(spark):
    rnd = random.Random(11)
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.randint(0, 300))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = plain_removal([t.encode() for t in texts], 12)
    got = suffix.removed(df, length=12, gram=4).collect()
    assert bag(r[:5] for r in got) == bag((i, *w) for i, w in enumerate(want))
    assert all(hashlib.sha256(r["text"].encode()).hexdigest() == r["kept_sha256"] for r in got)


def test_passages_of_fifty_words_go(spark):
    rnd = random.Random(12)
    word = lambda n: "".join(rnd.choice("abcdefghij") for _ in range(n))
    passage = " ".join(word(rnd.randint(2, 7)) for _ in range(58))
    own = [" ".join(word(6) for _ in range(90)) for _ in range(12)]
    assert 256 <= len(passage) < 400
    texts = [f"{o[:200]} {passage} {o[200:]}" if i % 2 else o for i, o in enumerate(own)]
    df = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    for r in suffix.deduplicated(df).collect():
        assert passage not in r["text"] and abs(len(r["text"]) - len(own[r["doc_id"]])) <= 6  # letters beside it may agree
        assert r["doc_id"] % 2 or r["text"] == own[r["doc_id"]]


def test_suffix_dedup_keeps_characters_whole(docs, none):
    out = suffix.deduplicated(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        assert r["text"] is None or r["n_chars"] == len(r["text"])
    assert suffix.removed(none).count() == 0 and suffix.deduplicated(none).count() == 0
    assert suffix.without("éab", [{"from": 1, "to": 3}]) == "éb"
    assert suffix.without("aéb", [{"from": 0, "to": 2}]) == "éb"


# -- pipeline ---------------------------------------------------------------------


def test_pipeline_stages_agree_with_brute_force(spark, docs, none, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES][1:3] == ["SimHash near-dedup", "suffix-array dedup"]
    step = docs
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        step = text.cut(stage(spark, step, ""), "test-stage")
        out[name] = step.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert step.columns == docs.columns
    cleaned = out["quality rules"]
    assert all(not plain_measures(r["text"])[5] or r["text"] for r in cleaned)
    prints = [plain_fingerprint(r["text"]) for r in cleaned]
    roots = plain_components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    assert len(out["SimHash near-dedup"]) == len(set(roots))
    left = [(r["text"] or "").encode() for r in out["SimHash near-dedup"]]
    gone = sum(w[1] for w in plain_removal(left, suffix.PASSAGE))
    kept = sum(len((r["text"] or "").encode()) for r in out["suffix-array dedup"])
    assert sum(map(len, left)) - gone <= kept <= sum(map(len, left)) - gone + 3 * len(left)
    assert all(r["round_trip"] for r in out["SentencePiece encoding"])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert bag(map(str, [[r] for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_pieces").collect()])) == bag(
        map(str, [[r] for r in step.select("doc_id", "n_pieces").collect()]))
    none.write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
