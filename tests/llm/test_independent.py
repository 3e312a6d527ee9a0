"""Queries and operators against restatements that share no code with them."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaestor.llm import idcoder, outliers, pieces, queries, urlfilter, warc


def spelled(processor, text: str | None) -> tuple:
    ids = processor.encode(text or "", add_bos=True, add_eos=True)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(processor.decode(ids).encode()).hexdigest()


@pytest.fixture(scope="module")
def processor():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer("piece_bpe_32k.model"))


def test_piece_query_equals_the_library(spark, data, processor):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op2_sentencepiece_chunks(spark, data).collect()}
    assert got == {i: spelled(processor, t) for i, t in texts.items()}


def test_pieces_of_awkward_texts_equal_the_library(spark, odd, processor):
    rows = odd.collect()
    got = sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.encode_decode(odd, queries.tokenizer("piece_bpe_32k.model"), outputs=False).collect())
    assert got == sorted(spelled(processor, r.text) for r in rows)


# --- segments -------------------------------------------------------------------------------------------------------
PAYLOAD = bytes(range(32, 127)) * 900


def archive(tmp_path, numbers, total=None, origin=True):
    """An archive of one page in four segments, of which those numbered are written in this order."""
    block = warc.HTTP + warc.chunked(PAYLOAD)
    size = -(-len(block) // 4)
    parts = {n: block[(n - 1) * size : n * size] for n in range(1, 5)}
    out = []
    for n in numbers:
        fields = {"WARC-Type": "response" if n == 1 else "continuation", "WARC-Record-ID": "<urn:uuid:a>" if n == 1 else f"<urn:uuid:{len(out)}>", "WARC-Segment-Number": str(n)}
        if n == 1:
            fields |= {"X-Page-ID": "7", "WARC-Payload-Digest": "sha1:" + warc.digest32(PAYLOAD)}
        elif origin:
            fields["WARC-Segment-Origin-ID"] = "<urn:uuid:a>"
        if n == 4:
            fields["WARC-Segment-Total-Length"] = str(len(block) if total is None else total)
        out.append(warc.record(fields, parts[n]))
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(out))
    return str(path), path.stat().st_size


@pytest.mark.parametrize("numbers,total,good", [
    ((1, 2, 3, 4), None, True),
    ((4, 2, 1, 3), None, True),
    ((1, 2, 4), None, False),
    ((1, 2, 3), None, False),
    ((2, 3, 4), None, False),
    ((1, 2, 2, 3, 4), None, False),
    ((1, 2, 3, 4), 5, False),
])
def test_segments_are_joined_or_told(spark, tmp_path, numbers, total, good):
    path, size = archive(tmp_path, numbers, total)
    manifest = spark.createDataFrame([(path, 0, size)], "file string, start bigint, length bigint")
    (row,) = warc.read_archives(manifest).collect()
    assert row.valid is good
    if good:
        assert (row.id, row.record_type, row.payload, row.digest) == (7, "response", PAYLOAD, warc.digest32(PAYLOAD))
    else:
        assert row.payload is None


# --- lists beyond the filter's bound --------------------------------------------------------------------------------
def test_lists_beyond_the_bound_give_the_same_verdicts(spark, data, monkeypatch):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    more = spark.createDataFrame([(-1, None), (-2, "no scheme"), (-3, "x://deep.spam-farm.example.org/a"), (-4, "x://notspam-farm.example.org/a")], "page_id bigint, url string")
    pages = pages.select("page_id", "url").unionByName(more)

    def verdicts():
        return sorted(map(tuple, urlfilter.judge(pages, urlfilter.listed_keys(spark), urlfilter.RULES).collect()))

    want = verdicts()
    monkeypatch.setattr(urlfilter, "MOST_BYTES", 0)
    assert verdicts() == want and any(r[-1] for r in want) and not all(r[-1] for r in want)


# --- frames of ids --------------------------------------------------------------------------------------------------
def test_frames_may_be_small_and_ids_too_large(spark, data, monkeypatch):
    ids = np.random.default_rng(3).integers(0, 900, 9001).astype(np.int32)
    names, sizes, back = idcoder.unpack_frame(idcoder.pack_frame([4, None, 9], [1, 0, 9000], ids))
    assert names == [4, None, 9] and sizes.tolist() == [1, 0, 9000] and (back == ids).all()
    with pytest.raises(ValueError, match="beyond"):
        idcoder.pack_frame([1], [1], np.array([1 << 16], np.int32))
    frame = bytearray(idcoder.pack_frame([4], [9001], ids))
    frame[-5] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        idcoder.unpack_frame(bytes(frame))


# --- minimum covariance determinant ---------------------------------------------------------------------------------
def plain_mcd(x: np.ndarray, share: float, rng) -> tuple[np.ndarray, np.ndarray]:
    """Fast MCD with random starts and exact subsets; scatter made that of all by simulation."""
    n, p = x.shape
    h = int(np.ceil(share * n))
    best = (np.inf, None)
    for _ in range(60):
        own = x[rng.choice(n, p + 1, replace=False)]
        for _ in range(25):
            centre, cov = own.mean(axis=0), np.cov(own, rowvar=False, bias=True) + 1e-9 * np.eye(p)
            far = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)
            own = x[np.argsort(far, kind="stable")[:h]]
        det = np.linalg.slogdet(np.cov(own, rowvar=False, bias=True))[1]
        best = min(best, (det, own), key=lambda b: b[0])
    own = best[1]
    z = rng.normal(size=(400_000, p))
    near = z[np.argsort((z**2).sum(axis=1))[: int(share * len(z))]]
    return own.mean(axis=0), np.cov(own, rowvar=False, bias=True) / near.var(axis=0).mean()


@pytest.mark.parametrize("bad", [0.0, 0.2])
def test_estimate_equals_a_plain_one(spark, bad):
    """Correlated coordinates, a fifth of the rows in a tight far cluster: centre, scatter and verdicts as by a plain search."""
    rng = np.random.default_rng(41)
    mix = np.array([[1, 0, 0, 0, 0], [0.05, 0.2, 0, 0, 0], [1, 1, 3, 0, 0], [0, 0.5, 1, 3, 0], [0.5, 0, 0, 1, 2]])
    x = rng.normal(size=(1500, 5)) @ mix.T + [5, 2, 20, 20, 10]
    planted = rng.random(len(x)) < bad
    x[planted] = rng.normal(size=(planted.sum(), 5)) * [0.2, 0.04, 0.5, 0.5, 0.4] + [11, 3.5, 50, 45, 30]
    points = spark.createDataFrame([("g", *map(float, r)) for r in x], "g string, " + ", ".join(f"{d} double" for d in outliers.DIMS))
    model = outliers.mcd(points).first()
    centre, inverse = np.array(model.centre), np.array(model.inverse).reshape(5, 5)
    want_centre, want_cov = plain_mcd(x, 0.75, rng)
    spread = np.sqrt(np.diag(want_cov))
    assert (np.abs(centre - want_centre) < 0.15 * spread).all()
    assert (np.abs(np.sqrt(np.diag(np.linalg.inv(inverse))) / spread - 1) < 0.12).all()

    def verdict(c, i):
        return np.einsum("ij,jk,ik->i", x - c, i, x - c) <= 25.74

    got, want = verdict(centre, inverse), verdict(want_centre, np.linalg.inv(want_cov))
    assert (got == want).mean() > 0.99 and not got[planted].any() and got[~planted].mean() > 0.99


def test_rows_of_equal_ids_are_judged_by_themselves(spark, odd):
    """Two rows of one id, one of them failing the base rules."""
    good = "some words stand here that no other line repeats again number "
    rows = [(1, " ".join(f"{good}{k}" for k in range(9))), (1, "short text"), (None, None)]
    out = outliers.judge(spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s")}))
    got = sorted((str(r.doc_id), r.n_words, r.base_failed, r.kept) for r in out.collect())
    assert [(g[0], g[2], g[3]) for g in got if g[1] < 50] == [("1", True, False), ("None", True, False)]
    assert len(got) == 3
