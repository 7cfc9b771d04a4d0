"""Token alignment, bit-plane clusters and binary records against plain versions, and on odd rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from conftest import TABLES
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from grainfold.llm import alignment, bitplanes, records, tokens
from grainfold.llm.queries import PIECES, QUERIES, TOKENIZER, WORDS
from grainfold.llm.tokens import split_units, unit_ids, word_ids

ODD = [
    "a  b", "  x", " ", "   ", "\n \n  y\t z ", "▁foo", "<|endoftext|> <s> <0x41>", "é ß日本語 🎉x", "a\x1c b  c  d  e",
    "don't  'stop' 12,34 x###  ", "", "word.\nnext line\n\n  again ", None, "\x00 nul", "aaaa" * 50 + " " + "ab" * 77, "x " * 30,
    "é ́a", "Σας ΣΑΣ İi", "\x7f a\x7fb", "don't we'll 'S 'T ÀÖØ×÷ ...", "no break  twice", "<|startoftext|>x<|endoftext|>",
    "longword" * 4000, " ".join(f"word{i % 97}x{i}." for i in range(8000)), "Copy me, please.", "Copy me, please.",
]
CLASHES = ("block", "n", "pair", "of", "key", "ids", "row", "planes", "norm", "cluster")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i // 2 * 2, text) for i, text in enumerate(ODD)] + [(None, "no id"), (None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("x") for n in CLASHES}).repartition(3)


@pytest.fixture(scope="module")
def some(spark):
    return spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").where("doc_id < 120")


# --- 11 -----------------------------------------------------------------------------------


def plain_alignment(rows):
    """Per row (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), token by token."""
    first = Tokenizer.from_file(TOKENIZER)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}

    def second_bytes(i):
        name = second.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if second.is_byte(i) else name.replace("▁", " ").encode()

    out, holders = [], Counter()
    for doc_id, text in rows:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        bytes_a, bytes_b = [bytes(byte_of[c] for c in first.id_to_token(i)) for i in a], [second_bytes(i) for i in b]
        if not text or not b"".join(bytes_a) == (" " + text).encode() == b"".join(bytes_b):
            out.append((doc_id, 0, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([*map(len, bytes_a)]).tolist(), np.cumsum([*map(len, bytes_b)]).tolist()
        owner_b = [j for j, own in enumerate(bytes_b) for _ in own]
        links = []
        for i, own in enumerate(bytes_a):
            links += [(a[i], b[j]) for j in sorted(set(owner_b[ends_a[i] - len(own) : ends_a[i]]))]
        groups, i, j, place_a, place_b = [], 0, 0, dict(zip(ends_a, range(1, 10**6))), dict(zip(ends_b, range(1, 10**6)))
        for end in sorted(set(ends_a) & set(ends_b)):
            groups.append("|".join(",".join(map(str, ids)) for ids in (a[i : place_a[end]], b[j : place_b[end]])))
            i, j = place_a[end], place_b[end]
        holders.update(set(links))
        out.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (i, _), n in holders.items():
        best[i] = max(best[i], n)
    return sorted(((d, na, nb, ng, len(x), sum(holders[p] == best[p[0]] for p in x), sum(holders[p] for p in x), h)
                   for d, na, nb, ng, x, h in out), key=str)


ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def alignment_rows(found):
    return sorted((tuple(row) for row in found.select(ALIGNED).collect()), key=str)


def test_alignment_equals_plain(odd, some):
    both = some.unionByName(odd.select("doc_id", "text"))
    rows = [tuple(row) for row in both.collect()]
    assert alignment_rows(alignment.aligned(both, TOKENIZER, PIECES)) == plain_alignment(rows)


def test_alignment_of_odd_columns_and_no_rows(odd):
    rows = [(row.doc_id, row.text) for row in odd.collect()]
    assert alignment_rows(alignment.aligned(odd, TOKENIZER, PIECES)) == plain_alignment(rows)
    assert alignment.aligned(odd.limit(0), TOKENIZER, PIECES).collect() == []
    empty = odd.where("text is null or text = ''")
    assert all(row[1:] == (0, 0, 0, 0, 0, 0, "") for row in alignment_rows(alignment.aligned(empty, TOKENIZER, PIECES)))


def test_twins_leave_the_pair_shuffle(some):
    aligner = alignment.Aligner(TOKENIZER, PIECES)
    for row in alignment.linked(some, TOKENIZER, PIECES).select("block_pairs").collect():
        assert all(aligner.same[code // aligner.width] != code % aligner.width for code in row[0])


def test_units_put_texts_together():
    texts = [text for text in ODD if text]
    for text, units in zip(texts, split_units(pa.array(texts)).to_pylist()):
        assert "".join(" " + unit for unit in units) == " " + text


def test_caches_start_anew(some, monkeypatch):
    """What a text gives does not hang on what the caches hold, or drop in between."""
    texts = [row.text or "" for row in some.collect()] + [text for text in ODD if text is not None]
    batches = [pa.array(texts[i : i + 7]) for i in range(0, len(texts), 7)]
    whole = [word_ids(WORDS).ids(b) for b in batches], [unit_ids(TOKENIZER).ids(b) for b in batches]
    aligned = [alignment.Aligner(TOKENIZER, PIECES).align(b) for b in batches]
    monkeypatch.setattr(tokens, "KEPT", 100)
    again = tokens.WordIds(WORDS), tokens.UnitIds(TOKENIZER)
    for own, expected in zip(again, whole):
        for batch, (values, sizes) in zip(batches, expected):
            got = own.ids(batch)
            assert (got[0] == values).all() and (got[1] == sizes).all()
    aligner = alignment.Aligner(TOKENIZER, PIECES)
    for batch, expected in zip(batches, aligned):
        got = aligner.align(batch)
        assert all(pa.array(got[name]).equals(pa.array(value)) for name, value in expected.items())


# --- 12 -----------------------------------------------------------------------------------


def test_dot_products_of_planes():
    draw = np.random.default_rng(5)
    for top in (1, 2, 256, 100_000):
        x, c = draw.integers(-top, top, (70, 64)), draw.integers(-top, top, (9, 64))
        planes = 1 + top.bit_length()
        assert (bitplanes.from_planes(bitplanes.to_planes(x, planes)) == x).all()
        px, pc = bitplanes.to_planes(x, planes), bitplanes.to_planes(c, planes)
        assert (bitplanes.dots(px, pc) == x @ c.T).all()
        assert (bitplanes.norms(px) == (x * x).sum(axis=1)).all()


def plain_clusters(rows, k, rounds):
    kept = [(i, [math_floor(256 * float(c)) for c in x]) for i, x in rows
            if x is not None and len(x) == 64 and all(c is not None and np.isfinite(c) for c in x)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(x) for _, x in order[:k]]

    def nearest(x):
        return min((sum((p - q) ** 2 for p, q in zip(x, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, x in kept:
            members[nearest(x)[1]].append(x)
        for i, own in members.items():
            centroids[i] = [sum(column) // len(own) for column in zip(*own)]
    found = [(i, *nearest(x)[::-1]) for i, x in kept]
    inertia = Counter()
    for _, cluster, distance in found:
        inertia[cluster] += distance
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, c, d in found], key=str)


def math_floor(x):
    return int(np.floor(x))


def test_clusters_of_odd_vectors(spark):
    draw = np.random.default_rng(3)
    rows = [(i, (draw.normal(size=64) * (50 if i % 7 == 0 else 1)).tolist()) for i in range(60)]
    rows += [(61, None), (62, []), (63, [1.0] * 63), (64, [None] + [1.0] * 63), (65, [float("nan")] + [1.0] * 63),
             (66, [float("inf")] + [1.0] * 63), (67, [1.0] * 65), (None, [2.0] * 64), (68, [0.0] * 64), (68, [0.0] * 64), (68, [-1.0] * 64)]
    rows += [(70 + i, [0.5] * 64) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({n: F.lit("x") for n in CLASHES})
    for k, rounds in ((5, 3), (200, 1), (40, 5)):
        got = sorted((tuple(row) for row in bitplanes.clusters(df, k, rounds).collect()), key=str)
        assert got == plain_clusters(rows, k, rounds)
    assert bitplanes.clusters(df.limit(0)).collect() == []
    assert bitplanes.clusters(df.where("vec_id = 61")).collect() == []
    with pytest.raises(ValueError, match="too large"):
        bitplanes.clusters(spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>"))


# --- 13 -----------------------------------------------------------------------------------


def plain_crc(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_checksums():
    assert records.crc32c([b"123456789"]).tolist() == [0xE3069283]
    parts = [random.Random(i).randbytes(4 + i * 7 % 600) for i in range(80)]
    assert records.crc32c(parts).tolist() == [plain_crc(part) for part in parts]


@pytest.mark.parametrize("path, make", [(WORDS, word_ids), (TOKENIZER, unit_ids)])
def test_ids_equal_the_tokenizer(some, path, make):
    plain, own = Tokenizer.from_file(path), make(path)
    texts = [text for text in ODD if text is not None] + [row.text or "" for row in some.collect()]
    values, sizes = own.ids(pa.array(texts))
    expected = [plain.encode(text, add_special_tokens=False).ids for text in texts]
    assert sizes.tolist() == [len(ids) for ids in expected]
    assert values.tolist() == [i for ids in expected for i in ids]


def test_records_equal_plain(odd, some):
    both = some.unionByName(odd.select("doc_id", "text").where("doc_id is not null").withColumn("doc_id", F.col("doc_id") + 1000))
    both = both.dropDuplicates(["doc_id"]).persist()
    plain, start, expected = Tokenizer.from_file(WORDS), 0, []
    for row in both.sort("doc_id").collect():
        ids = plain.encode(row.text or "", add_special_tokens=False).ids + [2]
        expected.append((row.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    stored = records.stored_documents(both, WORDS, 2)
    assert [tuple(row) for row in records.record_report(stored).collect()] == expected


def test_records_of_odd_rows(odd):
    found = records.record_report(records.stored_documents(odd, WORDS, 2)).collect()
    assert len(found) == len(ODD) + 2
    assert [row.doc_id for row in found[:2]] == [None, None]
    assert [row.start for row in found] == np.cumsum([0] + [row.n_tokens for row in found])[:-1].tolist()
    assert records.stored_documents(odd.limit(0), WORDS, 2).collect() == []


def test_shuffled_reads_and_damage(spark, tmp_path):
    path = str(tmp_path / "records")
    rows = spark.range(500).select(F.col("id").alias("key"), F.encode(F.repeat(F.lit("abcd"), (F.col("id") % 9).cast("int")), "utf-8").alias("ids"))
    records.write_records(rows.repartitionByRange(4, "key"), path)
    whole = {tuple(row) for row in records.read_records(spark, path).collect()}
    assert len(whole) == 500
    first = [row.key for row in records.shuffled_records(spark, path, 1).collect()]
    again = [row.key for row in records.shuffled_records(spark, path, 1).collect()]
    other = records.shuffled_records(spark, path, 2).collect()
    assert first == again != [row.key for row in other] and {tuple(row) for row in other} == whole
    records.write_records(rows.limit(3), path, "append")
    assert records.read_records(spark, path).count() == 503
    file = next(Path(path).glob("*.records"))
    data = bytearray(file.read_bytes())
    data[len(data) // 2] ^= 1
    file.write_bytes(data)
    with pytest.raises(Exception, match="damaged"):
        records.read_records(spark, path).collect()


def test_contract_queries(spark):
    for name, columns in (("op11_alignment", ALIGNED), ("op13_records", ["doc_id", "start", "n_tokens", "ids_crc32"])):
        found = QUERIES[name](spark, str(TABLES))
        assert set(columns) <= set(found.columns)
        assert found.count() == spark.read.parquet(f"{TABLES}/documents.parquet").count()
