"""The registered queries and the pipeline over the smallest driver tables."""

import math
import os

import pytest

import corpus_pipeline
from tests.llm import brute
from tidemark.llm import line_dedup, queries
from tidemark.llm.common import read, stored
from tidemark.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")


@pytest.fixture(scope="module")
def con():
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    return round(v, 9) if isinstance(v, float) and math.isfinite(v) else v


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in columns) for r in df.collect()), key=repr)
    res = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(_norm(r[names.index(c)]) for c in columns) for r in res.fetchall()), key=repr)


def test_near_duplicate_query_equals_brute_force(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op7_near_dup"](spark, SF).collect()}
    sets = {r["doc_id"]: brute.shingles(r["text"], 4) for r in read(spark, SF, "documents").collect()}
    want = brute.components(sets)
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == {
        i: (len(s), want[i], want[i] == i) for i, s in sets.items()}


def test_bpe_query_equals_the_library(spark):
    from hashlib import sha256

    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = {}
    for r in read(spark, SF, "documents").collect():
        ids = tok.encode(r["text"] or "", add_special_tokens=False).ids
        decoded = tok.decode(ids, skip_special_tokens=False)
        want[r["doc_id"]] = (len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256(decoded.encode()).hexdigest())
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op10_bpe"](spark, SF).collect()}
    assert got == want


def test_secret_query_digests(spark):
    from hashlib import sha256

    from tests.llm.test_small_tables import base_spans

    texts = {r["doc_id"]: r["text"] for r in read(spark, SF, "documents").collect()}
    for r in queries.QUERIES["op5_secrets"](spark, SF).collect():
        spans = base_spans(texts[r["doc_id"]] or "")
        assert [r[f"n_{k}"] for k in ("assign", "access", "hex")] == [
            sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]
        assert r["base_sha256"] == sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def test_language_query_held_out_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in read(spark, SF, "documents").collect()}
    held = [r for r in queries.QUERIES["op1_language_id"](spark, SF).collect() if r["held_out"]]
    assert len(held) > 20 and sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_quality_query_agrees_with_labels(spark):
    quality = {r["doc_id"]: r["quality"] for r in read(spark, SF, "labels").collect()}
    kept = {r["doc_id"]: (r["kept"], r["n_words"]) for r in queries.QUERIES["op4_quality"](spark, SF).collect()}
    clean = [kept[i][0] for i, q in quality.items() if q == 1 and i in kept and kept[i][1] >= 20]
    assert clean and all(clean)


def test_token_count_query_recounts(spark):
    import public_tokenizers as P

    from hashlib import sha256
    from tidemark.llm import token_counts

    coder = token_counts.Counter(open(vocabulary("byte_bpe_50k.tiktoken"), "rb").read(), P.PATTERN).coder
    docs = {r["doc_id"]: r for r in read(spark, SF, "documents").collect()}
    for r in queries.QUERIES["op3_token_counts"](spark, SF).collect():
        d = docs[r["doc_id"]]
        t, n = d["text"], len(d["text"])
        t = t[:n // 2] + f" [{d['source']}]'" + t[n // 2 + 20:]
        t = d["lang"].upper() + ": " + t
        t = t[:max(0, n - 25)] + t[n + 100:]
        assert (r["n_tokens_before"], r["n_tokens_after"], r["text_sha256"]) == (
            len(coder.encode_ordinary(d["text"])), len(coder.encode_ordinary(t)), sha256(t.encode()).hexdigest())


def brute_cut(rows):
    """Line dedup of (id, text, lang, source) rows."""
    from collections import Counter

    def mark(line):
        return line.strip(line_dedup.BLANKS)

    pages, counts = Counter(), Counter()
    for text, source in {(text, source) for _, text, _, source in rows if text is not None}:
        pages[source] += 1
        counts.update({(source, mark(x)) for x in text.split("\n") if mark(x)})
    often = {k for k, n in counts.items() if n >= line_dedup.MIN_PAGES and n > line_dedup.RATIO * pages[k[0]]}
    return [(i, None if t is None else "\n".join(x for x in t.split("\n") if (s, mark(x)) not in often), lang, s)
            for i, t, lang, s in rows]


def test_pipeline_stages_equal_brute_force(spark):
    """Each stage on its predecessor's rows, and run() as their chain."""
    from collections import Counter

    from tokenizers import Tokenizer

    from tidemark.llm import mixing, quality

    docs = stored(read(spark, SF, "documents"), "test-docs")
    columns = docs.columns
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF), f"test-{name}")
        results[name] = (docs.collect(), out.collect())
        if name != "bpe":
            assert out.columns == columns
            docs = out

    def rows(found):
        return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in found]

    before, after = results["quality_rules"]
    refs = quality.references(stored(read(spark, SF, "documents"), "test-docs"))
    assert sorted(rows(after)) == sorted(r for r in rows(before) if quality.measure(r[1].encode(), r[2], refs)[6])
    before, after = results["line_dedup"]
    assert sorted(rows(after)) == sorted(brute_cut(rows(before)))
    assert all(r["n_chars"] == len(r["text"]) for r in after)
    before, after = results["near_dedup"]
    want = brute.components({r["doc_id"]: brute.shingles(r["text"], 5) for r in before})
    assert sorted(rows(after)) == sorted(r for r in rows(before) if want[r[0]] == r[0])
    before, after = results["mix_sources"]
    copies = {r["doc_id"]: r["copies"] for r in mixing.assign_positions(docs.sparkSession.createDataFrame(before)).collect()}
    assert Counter(rows(after)) == Counter({r: copies[r[0]] for r in rows(before) if copies[r[0]]})
    before, after = results["bpe"]
    tok = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = [(r["doc_id"], tok.encode(r["text"], add_special_tokens=False).ids) for r in before]
    assert sorted((r["doc_id"], r["ids"]) for r in after) == sorted(want)
    assert sorted((r["doc_id"], r["ids"]) for r in corpus_pipeline.run(spark, SF).collect()) == sorted(want)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_pipeline_stages_take_odd_rows(spark, name):
    """Nulls in any column, empty texts, repeated rows, extra clashing columns."""
    kind = ("doc_id long, text string, lang string, source string, n_chars long, kept string, positions int, "
            "n_lines int, size int")
    text = "the quick brown fox jumps over the lazy dog and then it runs far away into the deep dark wood again today"
    rows = [(1, text, "en", "a", 5, "x", 1, 2, 3), (1, text, "en", "a", 5, "x", 1, 2, 3), (2, None, None, None, None, None, None, None, None),
            (None, text + " now", "en", None, 1, None, None, None, None), (3, "", "en", "a", 0, "x", 1, 2, 3), (4, text, None, "b", 5, None, 1, 2, 3)]
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = stored(spark.createDataFrame(rows, kind), "odd")
    out = stage(spark, docs, SF)
    found = out.collect()
    if name != "bpe":
        assert out.columns == docs.columns
    ids = sorted(r["doc_id"] or 0 for r in found)
    if name == "quality_rules":
        assert ids == [0, 1, 1, 4]
    if name in ("line_dedup", "bpe"):
        assert ids == [0, 1, 1, 2, 3, 4]
    if name == "near_dedup":
        assert ids == [1, 2, 3]  # the row without an id is a near copy of document 1
    if name == "mix_sources":
        assert 2 not in ids and 3 not in ids and 0 in ids
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_mix_sources_places_rows_without_an_id(spark):
    """Rows that share an id, or have none, are taken by their own places."""
    from collections import Counter

    docs = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"own{i} " * (i % 17), "en", "abc"[i % 2], 0) for i in range(300)]
    docs.append((None, "", "en", "a", 0))
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline.mix_sources(spark, table, SF).collect()
    times = Counter(r["text"] for r in found)
    assert "" not in times and max(times.values()) <= 2
    sizes, taken = Counter(), Counter()
    for _, text, _, source, _ in docs:
        sizes[source] += len(text.split())
        taken[source] += len(text.split()) * times[text]
    from tests.llm.test_small_tables import brute_targets

    want = brute_targets(sizes)
    assert all(abs(taken[s] - want[s]) <= 17 for s in sizes)
    assert any(r["doc_id"] is None for r in found)


def test_near_copies_are_one_page_of_their_host(spark):
    """6 near copies among 60 pages keep their lines until one of them is kept;
    a line that the host's other pages repeat is cut."""
    import random

    r = random.Random(8)

    def page():
        return [" ".join(f"w{r.randrange(10**6)}" for _ in range(12)) for _ in range(10)]

    copied, rows = page(), []
    for i in range(60):
        lines = page()
        if i < 6:
            lines = list(copied)
            lines[i] = f"changed{i} " + lines[i].split(" ", 1)[1]
        rows.append((i, "\n".join([*lines, "home about"]), "en", "h", 0))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    cut = stored(corpus_pipeline.dedup_lines(spark, table, SF), "test-near-copies")
    want = {i: text.removesuffix("\nhome about") for i, text, *_ in rows}
    assert {x["doc_id"]: x["text"] for x in cut.collect()} == want
    kept = {x["doc_id"]: x["text"] for x in corpus_pipeline.near_duplicates(spark, cut, SF).collect()}
    assert kept == {i: t for i, t in want.items() if not 0 < i < 6}


def test_near_copies_without_an_id_are_kept_once(spark):
    import random

    r = random.Random(9)
    base = [[f"w{r.randrange(10**6)}" for _ in range(60)] for _ in range(3)]

    def near(k, i):
        return " ".join([*base[k][:-1], f"end{i}"])

    rows = [(5, near(0, 0)), (None, near(0, 0).upper()), (None, near(0, 1))]       # the group of document 5
    rows += [(None, near(0, 2) + " and"), (5, near(2, 7))]                          # no copy of a text; another text under its id
    rows += [(None, near(1, i)) for i in range(4)] + [(None, near(1, 0))]           # a group without ids
    rows += [(None, " ".join(base[1][::-1])), (None, ""), (None, None), (None, ""), (6, "")]
    table = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    found = [(x["doc_id"], x["text"]) for x in corpus_pipeline.near_duplicates(spark, stored(table, "unnamed"), SF).collect()]
    group = [x for x in found if x[1] and x[1].startswith(base[1][0])]
    assert len(group) == 1 and group[0] in rows
    rest = [x for x in found if x not in group]
    assert sorted(rest, key=repr) == sorted([(5, near(0, 0)), (5, near(2, 7)), (None, " ".join(base[1][::-1])), (None, ""), (None, None), (6, "")], key=repr)


def test_chat_query_of_odd_ids_matches_oracle(spark, tmp_path):
    """Negative and null conversation ids; rows without an id are one each."""
    turns = [(i, t, ("user", "assistant")[t % 2], f"say {i} {t} more words") for i in (-4, -3, 2, 3) for t in range(4)]
    turns += [(None, 0, "assistant", "a b c"), (None, 1, "user", "x"), (None, 0, "assistant", "a b c"), (None, None, None, None)]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").coalesce(1).write.parquet(
        str(tmp_path / "conversations.parquet"))
    got = queries.QUERIES["op6_chat_format"](spark, str(tmp_path))
    import duckdb

    odd = duckdb.connect()
    odd.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = odd.execute(queries.ORACLE_SQL["op6_chat_format"])
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(want.fetchall(), key=repr)
    assert got.count() == 8
