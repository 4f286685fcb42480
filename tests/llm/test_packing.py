import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from lineweave.llm.packing import best_fit_decreasing, op8_pack, packed_pieces, plan_sequences, reduce_dominated
from lineweave.llm.token_output import op5_token_ids, position_ids, positions_of_resets, read_resets, read_shard, write_packed_ids
from lineweave.llm.tokens import Encoder, piece_sizes
from lineweave.session import shared_dir

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reference():
    return tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))


def ids_of(reference, text):
    return [*reference.encode(text or "", add_special_tokens=False).ids, 2]


ODD = ["", " ", "  ", "a b", "a  b", "a   b", "a\n b", "a \n b", "a\n\n  b  ", " lead", "trail ", "x\n ", "\t \t", "it's  'll we'd", "a\xa0 b", "a \xa0b", "a   b", "\x1c x", "<|endoftext|> x", "y <|endoftext|>", "naïve façade 日本 語 🙂 x", "1 22  333", "\r\n \r\n", "a\x0b \x0cb", "​ a"]


def test_ids_are_those_of_the_library(reference):
    rng = random.Random(1)
    pieces = [" ", "  ", "\n", "\t", "word", "Ünï", "12", "%%", "'s", "\xa0", "　", "\x1f", "\x85", "<|endoftext|>"]
    texts = ODD + ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14))) for _ in range(4000)]
    for encoder in (Encoder(), Encoder(ranks=None)):
        for t in texts:
            assert np.frombuffer(encoder.ids(t), "<u4").tolist() == reference.encode(t, add_special_tokens=False).ids, repr(t)


def optimum(lengths, width):
    """Fewest sequences, by trying every assignment in turn."""
    for n in itertools.count(-(-sum(lengths) // width)):
        seen = {tuple([width] * n)}
        for x in sorted(lengths, reverse=True):
            seen = {tuple(sorted((*s[:i], s[i] - x, *s[i + 1 :]))) for s in seen for i in range(n) if s[i] >= x}
        if seen:
            return n


def test_reduction_keeps_the_optimum_and_the_plan_holds_all_pieces():
    rng = random.Random(2)
    for _ in range(250):
        width = rng.choice([8, 12, 20, 30])
        counts = Counter(rng.randint(1, width - 1) for _ in range(rng.randint(1, 9)))
        best = optimum(list(counts.elements()), width)
        fixed, rest = reduce_dominated(dict(counts), width)
        assert sum(n for _, n in fixed) + (optimum(list(Counter(rest).elements()), width) if rest else 0) == best
        groups = plan_sequences(dict(counts), width)
        assert all(sum(x * m for x, m in p) <= width for p, _ in groups)
        held = Counter()
        for p, n in groups:
            for x, m in p:
                held[x] += m * n
        assert held == counts
        assert best <= sum(n for _, n in groups) <= sum(n for _, n in best_fit_decreasing(dict(counts), width))


def check(rows, docs, reference, width):
    expected = []
    for doc_id, text in docs:
        ids, start = ids_of(reference, text), 0
        for piece, size in enumerate(piece_sizes(len(ids), width)):
            expected.append((doc_id, piece, start, size, zlib.crc32(np.array(ids[start : start + size], "<u4").tobytes())))
            start += size
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=str) == sorted(expected, key=str)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= width
    return len(by_sequence), -(-sum(e[3] for e in expected) // width)


def test_documents_fill_nearly_the_fewest_sequences(spark, reference):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    used, least = check(op8_pack(spark, SF001).collect(), docs, reference, 1024)
    assert used <= least * 1.02 + 1


def test_packing_cases(spark, reference):
    schema = "doc_id long, text string, length int, part int, rank int, sequence_id int, offset int, lo int"
    rows = [(1, None), (2, ""), (None, "a b c"), (3, "same"), (3, "same"), (4, "word " * 9000), *((i, t) for i, t in enumerate(ODD, 10))]
    docs = spark.createDataFrame([(*r, *[None] * 6) for r in rows], schema)
    check(packed_pieces(docs, width=16).collect(), rows, reference, 16)
    assert packed_pieces(docs.limit(0)).count() == 0


def test_shards_give_every_document_back(spark, reference):
    path = shared_dir(spark, "test-shards")
    rows = [(1, None), (2, ""), (None, "a b c"), (3, "same"), (3, "same"), (4, "word " * 3000), *((i, t) for i, t in enumerate(ODD, 10))]
    docs = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, row int, shard string")
    out = write_packed_ids(docs, path, width=64, window_rows=4).collect()
    shards = {s: read_shard(path, s, 64) for s in {r["shard"] for r in out}}
    assert sum(len(ids) for ids, _ in shards.values()) == len(out)
    resets = {s: read_resets(path, s, 64) for s in shards}
    for s, (ids, cus) in shards.items():
        assert resets[s].shape == ids.shape
        assert all((positions_of_resets(row) == position_ids(cu, 64)).all() for row, cu in zip(resets[s], cus))
    pieces = {}
    for r in out:
        ids, cu = shards[r["shard"]][0][r["row"]], shards[r["shard"]][1][r["row"]]
        assert cu.tolist() == r["cu_lengths"] and r["n_ids"] == cu[-1] <= 64 and r["n_segments"] == len(cu) - 1
        assert zlib.crc32(ids[: cu[-1]].astype("<u4").tobytes()) == r["ids_crc32"] and (ids[cu[-1] :] == 2).all()
        positions = position_ids(cu, 64)
        for s, a, b in zip(r["segments"], cu[:-1], cu[1:]):
            assert positions[a:b].tolist() == list(range(b - a)) and s["length"] == b - a
            pieces.setdefault((s["doc_id"], s["piece"]), []).append((s["start"], ids[a:b].tolist()))
    whole = {}
    for (doc_id, _), found in sorted(pieces.items(), key=str):
        for start, ids in found:
            whole.setdefault(doc_id, []).append((start, ids))
    for doc_id, text in rows:
        if doc_id != 3:
            assert [x for _, ids in sorted(whole[doc_id]) for x in ids] == ids_of(reference, text)
    assert [ids for _, ids in whole[3]] == [ids_of(reference, "same")] * 2
    assert write_packed_ids(docs.limit(0), path).count() == 0


def test_token_query_covers_all_ids(spark, reference):
    total = sum(len(ids_of(reference, r["text"])) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect())
    rows = op5_token_ids(spark, SF001).collect()
    assert sum(r["n_ids"] for r in rows) == total and len(rows) <= 1.05 * total / 1024 + 8
