import hashlib
import math

from lineweave.llm.fingerprint import decode, digests, encode, fingerprints, likeness, op2_fingerprint

SF001 = "/root/testdata/sf0.001"


def plain_digest(text):
    """The digest in plain loops over bytes: (head, quartile of every bucket)."""
    data, counts = text.encode(), [0] * 256
    for far, factor in ((2, 0x9E3779B1), (3, 0x85EBCA6B)):
        for i in range(len(data) - far):
            value = data[i] + 256 * data[i + 1] + 65536 * data[i + far]
            value = (value * factor % 2**32) ^ (value >> 7)
            counts[value * factor % 2**32 >> 24] += 1
    low, mid, high = (sorted(counts)[i] for i in (63, 127, 191))
    length = min(255, round(math.log1p(len(data)) * 255 / math.log1p(1e8)))
    head = [length, min(15, 16 * low // max(high, 1)), min(15, 16 * mid // max(high, 1)), min(15, counts.count(0) // 16)]
    return head, [(c > low) + (c > mid) + (c > high) for c in counts]


def plain_text(digest):
    head, body = digest
    out = [head[0], head[1] + 16 * head[2], head[3]]
    out += [sum(body[i + j] * 4**j for j in range(4)) for i in range(0, 256, 4)]
    return bytes(out).hex()


def plain_likeness(x, y):
    gaps = [abs(a - b) for a, b in zip(x[1], y[1])]
    return 1 - min(512, sum(gaps) + 3 * gaps.count(3) + sum(abs(a - b) for a, b in zip(x[0], y[0]))) / 512


def model(rows):
    """rows in order: what the query returns for each."""
    out = []
    for k, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, new, other = map(plain_digest, (text, edited, following))
        near = [round(plain_likeness(own, x), 9) for x in (new, other)]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), plain_text(own), plain_text(new), *near))
    return out


def rows_of(df):
    return [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in df.collect()]


def test_matches_the_model_row_by_row(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect())
    got = sorted(rows_of(op2_fingerprint(spark, SF001)))
    assert got == model(docs)
    assert sum(r[5] > r[6] for r in got) > 0.95 * len(got)


def test_likeness_follows_the_edits():
    text = b" ".join(b"word%d" % (i * i % 997) for i in range(800))
    codes = [digests([text[:cut] + text[::-1][: len(text) - cut]]) for cut in (len(text), len(text) * 9 // 10, len(text) // 2, 0)]
    near = [float(likeness(codes[0], c)[0]) for c in codes]
    assert near[0] == 1.0 and near[0] > near[1] > near[2] and all(0 <= x <= 1 for x in near)
    for c in codes:
        assert (decode(encode(c)[0]) == c).all()


def test_cases(spark):
    schema = "doc_id long, text string, n_chars int, part int, edge int, fingerprint string, following string"
    rows = [(1, None), (2, ""), (3, "é"), (4, "ab"), (5, "abc€" * 20_000), (6, "x" * 50), (None, "last of all")]
    docs = spark.createDataFrame([(*r, *[None] * 5) for r in rows], schema).repartition(5)
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(rows_of(fingerprints(docs)), key=key) == model(rows)
    single = rows_of(fingerprints(docs.where("doc_id = 4")))
    assert single == model([(4, "ab")]) and single[0][6] == 1.0
    twice = rows_of(fingerprints(spark.createDataFrame([(7, "same text"), (7, "same text")], "doc_id long, text string")))
    assert len(twice) == 2 and twice[0] == twice[1]
    assert fingerprints(docs.limit(0)).count() == 0
