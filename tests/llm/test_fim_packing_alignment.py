"""Fill-in-the-middle, packing and alignment against plain versions: the
registered queries on the smallest driver table, and the operators on odd rows."""

import os
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_small_tables import ODD, collect, docs
from tidemark.llm import alignment, byte_bpe, fim, packing, queries
from tidemark.llm.common import read
from tidemark.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"
driver_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")

TRICKY = ["Hello, <|endoftext|> Wörld's  'tis don't!! 12 \n x", "  two before, two after  ", "\n \n", " ", "a\n\n", "a \t b",
          "日本語 text ١٢ ²½Ⅷ 😀👍🏽 ​　\x85\xa0x\x1c\x1d y", "a▁b c", "end ", "x" * 3000, "<0x41> <s> </s> <unk>", "a  b",
          "tabs\there  and\r\nthere", "ﬁ Å é", "\x00 zero", "<P>", "pre<P>x", "a<", "<S", "b>c", "<P"]


def hexed(text: str) -> str:
    return sha256(text.encode()).hexdigest()


# ------------------------------------------------- fill in the middle

def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    assert "".join(units) == text
    h = hexed(f"1:{'' if doc_id is None else doc_id}")
    h = [int(h[k:k + 8], 16) for k in (0, 8, 16, 24)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, hexed(text), hexed(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, form, len(p), len(m), hexed(out), hexed(text)


@driver_data
def test_fim_query_equals_brute_force(spark):
    got = collect(queries.QUERIES["op11_fill_in_middle"](spark, SF))
    assert got == sorted((plain_fim(r["doc_id"], r["text"]) for r in read(spark, SF, "documents").collect()), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_fim_odd_rows_and_restoration(spark, monkeypatch):
    monkeypatch.setattr(fim, "BLOCK", 7)  # units that run over block borders
    rows = ODD[:-1] + [(6, "é" * 50 + " " + "x y " * 100)] + [(100 + 7 * k + j, t) for k, t in enumerate(TRICKY) for j in range(6)]
    got = collect(fim.fill_in_middle_digests(docs(spark, rows)))
    assert got == sorted((plain_fim(i, t) for i, t, *_ in rows), key=repr)
    out = fim.fill_in_middle(docs(spark, rows))
    shown = out.collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, hexed(r["output"])) for r in shown) == sorted(
        (r[0] is not None, r[0] or 0, r[5]) for r in got)
    for r in shown:  # a descriptor list for each row, over the two buffers
        assert len(r["pieces"]) == (1 if r["form"] == "plain" else 6)
        assert sum(p["length"] for p in r["pieces"] if p["buffer"] == "text") + 9 * (r["form"] != "plain") == len(r["output"].encode())
    assert collect(fim.restore(out)) == sorted(((i, t or "") for i, t, *_ in rows), key=repr)


def test_fim_empty_table_and_bad_output(spark):
    assert fim.fill_in_middle(docs(spark, [])).count() == 0
    bad = spark.createDataFrame([(1, "no sentinel", "psm")], "doc_id long, output string, form string")
    with pytest.raises(Exception, match="sentinel"):
        fim.restore(bad).collect()
    nulls = spark.createDataFrame([(1, None, "psm"), (2, "x", None)], "doc_id long, output string, form string")
    assert collect(fim.restore(nulls)) == [(1, None), (2, None)]


def test_cut_splits_descriptors():
    assert fim.cut([(0, 0, 5)], 0, 5) == [(0, 0, 0), (0, 0, 5), (0, 5, 0)]
    assert fim.cut([(0, 0, 0)], 0, 0) == [(0, 0, 0)] * 3
    assert fim.cut([(0, 2, 3), (1, 0, 4)], 1, 3, 5) == [(0, 2, 1), (0, 3, 2), (1, 0, 0), (1, 0, 2), (1, 2, 2)]


# ------------------------------------------------------------- packing

@lru_cache
def library(special_as_text):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    tok.encode_special_tokens = special_as_text
    return tok


def library_ids(texts, special_as_text=False):
    return [e.ids for e in library(special_as_text).encode_batch(texts, add_special_tokens=False)]


def check_packed(rows, want: Counter, size=1024):
    """``rows`` (doc_id, start, length, crc, doc_tokens, sequence_id, offset) hold
    each wanted (doc_id, ids) once, in gapless sequences; returns the padding."""
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r[5]].append((r[6], r[2]))
        by_doc[r[0]].append(r)
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= size
    assert sorted(by_seq) == list(range(len(by_seq)))
    for (doc_id, ids), n in want.items():
        ids = np.array(ids, "<u4")
        mine = [r for r in by_doc[doc_id] if r[4] == len(ids)]
        covered = Counter((r[1], r[2]) for r in mine if r[3] == zlib.crc32(ids[r[1]:r[1] + r[2]].tobytes()))
        starts = defaultdict(list)
        for (a, k), c in covered.items():
            starts[a] += [k] * c
        for _ in range(n):  # walk through the document's pieces
            at = 0
            while at < len(ids):
                at += starts[at].pop()
            assert at == len(ids)
    assert sum(r[2] for r in rows) == sum(len(ids) * n for (_, ids), n in want.items())
    used = [sum(k for _, k in p) for p in by_seq.values()]
    return sum(size - u for u in used if u & (u - 1)), len(used)


@driver_data
def test_packing_query_holds_every_id_once(spark):
    rows = [tuple(r) for r in queries.QUERIES["op12_packing"](spark, SF).collect()]
    table = read(spark, SF, "documents").collect()
    ids = library_ids([r["text"] or "" for r in table])
    padding, sequences = check_packed(rows, Counter((r["doc_id"], (*x, 0)) for r, x in zip(table, ids)))
    assert padding < 0.02 * 1024 * sequences


def test_packing_odd_rows(spark):
    rows = ODD + [(100 + k, t) for k, t in enumerate(TRICKY)] + [(200, "one word " * 3000)] * 3
    ids = library_ids([t or "" for _, t, *_ in rows])
    packed = packing.pack(docs(spark, rows), vocabulary("byte_bpe_50k.json"))
    shown = packed.withColumn("ids", F.crc32("ids")).collect()
    check_packed([tuple(r) for r in shown], Counter((r[0], (*x, 0)) for r, x in zip(rows, ids)))
    for r in packing.sequences(packed).collect():
        assert len(r["ids"]) == 4 * r["length"] <= 4096 and len(r["doc_ids"]) == len(r["offsets"])
    bare = packing.pack(docs(spark, [(1, None), (2, "a b")]), vocabulary("byte_bpe_50k.json"), end_id=None)
    assert [(r["doc_id"], r["start"], r["length"], r["sequence_id"]) for r in bare.collect()] == [(2, 0, 2, 0)]
    assert packing.pack(docs(spark, []), vocabulary("byte_bpe_50k.json")).count() == 0


def listed(places):
    """The plan's places one by one."""
    for p in places:
        for rank in range(p.low, p.high):
            i = rank - p.low
            yield p.length, rank, p.start, p.taken, p.sequence + i // p.each, p.offset + p.taken * (i % p.each)


def test_plan_is_gapless_and_near_full():
    r = random.Random(3)
    cases = [{300: 1000}, {1024: 5}, {1: 5000}, {513: 999}, {1023: 7, 1: 3}, {}, {700: 3, 400: 2},
             *({r.randrange(1, 1025): r.randrange(1, 60) for _ in range(r.randrange(1, 120))} for _ in range(60))]
    for histogram in cases:
        rows = list(listed(packing.plan(histogram)))
        by_piece, by_seq = defaultdict(list), defaultdict(list)
        for length, rank, start, taken, seq, offset in rows:
            by_piece[(length, rank)].append((start, taken))
            by_seq[seq].append((offset, taken))
        assert sorted(by_piece) == sorted((n, k) for n, c in histogram.items() for k in range(c))
        for (length, _), parts in by_piece.items():
            assert [a for a, _ in sorted(parts)] + [length] == [0, *np.cumsum([k for _, k in sorted(parts)]).tolist()]
        for parts in by_seq.values():
            assert [a for a, _ in sorted(parts)] == [0, *np.cumsum([k for _, k in sorted(parts)]).tolist()[:-1]]
            assert sum(k for _, k in parts) <= 1024
        assert sorted(by_seq) == list(range(len(by_seq)))
        tokens = sum(n * c for n, c in histogram.items())
        assert len(by_seq) <= -(-tokens // (1024 - packing.MIN_CUT)) + 1


def test_shortest_pack_first_equals_one_by_one():
    r = random.Random(8)
    for _ in range(40):
        histogram = {r.randrange(1, 101): r.randrange(1, 20) for _ in range(12)}
        items = [packing.Item(n, 0, 0, c) for n, c in histogram.items()]
        got = Counter()
        for used, runs, count in packing.shortest_pack_first(items, 100):
            lengths = [items[i].length for i, m in runs for _ in range(m)]
            assert sum(lengths) == used <= 100
            got[used] += count
        packs: list[int] = []
        for n in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
            shortest = min(packs, default=101)
            if shortest + n <= 100:
                packs.remove(shortest)
                packs.append(shortest + n)
            else:
                packs.append(n)
        assert got == Counter(packs)


def test_plan_of_many_pieces_stays_small():
    places = packing.plan({n: 10 ** 12 + n for n in range(1, 1025)})
    assert len(places) < packing.MAX_PLACES // 4
    assert sum(p.taken * (p.high - p.low) for p in places) == sum(n * (10 ** 12 + n) for n in range(1, 1025))


# ----------------------------------------------------------- alignment

def plain_alignment(rows):
    import sentencepiece

    a, b = byte_bpe.ByteBpe(open(vocabulary("byte_bpe_50k.json")).read()), sentencepiece.SentencePieceProcessor(
        model_file=vocabulary("piece_bpe_32k.model"))
    found, counts = [], Counter()
    for doc_id, text in rows:
        text = text or ""
        sides = []
        if text:
            ids_a = library_ids([" " + text], special_as_text=True)[0]
            ids_b = b.encode(text)
            bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
                       for i in ids_b for p in [b.id_to_piece(i)]]
            bytes_a = [a.pieces[i] for i in ids_a]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                sides = [(ids_a, np.cumsum([len(x) for x in bytes_a]).tolist()),
                         (ids_b, np.cumsum([len(x) for x in bytes_b]).tolist())]
        links, groups, i, j, group = [], [], 0, 0, ([], [])
        if sides:
            (ids_a, ends_a), (ids_b, ends_b) = sides
            group[0].append(ids_a[0]), group[1].append(ids_b[0])
            while True:
                links.append((ids_a[i], ids_b[j]))
                if ends_a[i] == ends_b[j]:
                    groups.append("|".join(",".join(map(str, x)) for x in group))
                    i, j, group = i + 1, j + 1, ([], [])
                    if i == len(ids_a):
                        break
                    group[0].append(ids_a[i]), group[1].append(ids_b[j])
                elif ends_a[i] < ends_b[j]:
                    i += 1
                    group[0].append(ids_a[i])
                else:
                    j += 1
                    group[1].append(ids_b[j])
        counts.update(links)
        found.append((doc_id, len(sides[0][0]) if sides else 0, len(sides[1][0]) if sides else 0, groups, links))
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return sorted(((i, n_a, n_b, len(g), len(ls), sum(counts[x] == most[x[1]] for x in ls), sum(counts[x] for x in ls),
                    hexed(";".join(g)) if g else "") for i, n_a, n_b, g, ls in found), key=repr), counts


@driver_data
def test_alignment_query_equals_brute_force(spark):
    want, counts = plain_alignment((r["doc_id"], r["text"]) for r in read(spark, SF, "documents").collect())
    assert collect(queries.QUERIES["op13_alignment"](spark, SF)) == want


def test_alignment_odd_rows_blocks_and_pairs(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 2000)  # several blocks a task
    rows = ODD[:-1] + [(i, t) for i, t in enumerate(TRICKY * 3)] + [(300, "é" * 300 + " " + "x y " * 500), (301, None)]
    found = alignment.align(docs(spark, rows), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    want, counts = plain_alignment([(i, t) for i, t, *_ in rows])
    assert collect(found.documents) == want
    pairs = found.pairs.where("count > 0").collect()
    assert len(pairs) == len(counts) and {(r["a_id"], r["b_id"]): r["count"] for r in pairs} == counts


def test_alignment_empty_tables(spark):
    paths = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    assert alignment.align(docs(spark, []), *paths).documents.count() == 0
    none = alignment.align(docs(spark, [(1, None), (None, "")]), *paths)
    assert collect(none.documents) == [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]
    assert none.pairs.count() == 0


def test_vocabulary_of_other_kind_is_refused():
    with pytest.raises(ValueError, match="byte-level"):
        byte_bpe.ByteBpe(open(vocabulary("word_bpe_49k.json")).read())
