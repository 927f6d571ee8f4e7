import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from curvelab.llm import cutting_stock, packing, token_counts, token_files
from curvelab.llm.pieces import pieces, vocabulary_path

WORD, BYTE = vocabulary_path("word_bpe_49k.json"), vocabulary_path("byte_bpe_50k.json")
ODD = st.text(alphabet=st.sampled_from(list("aZé×÷ßÿ 09'.,!#|<>\n\t\r\x0b\x00  日İΣ́")), max_size=40)
SPECIAL = st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "it's we'll", "  x", "don't.'s", "a\n b", "x \n\n y"])


def ids_of(path, text):
    return pieces(path).library.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(ODD, SPECIAL, st.tuples(ODD, SPECIAL, ODD).map("".join), st.none()), max_size=5))
def test_units_encode_like_the_library(path, texts):
    ids, offsets = pieces(path).encode(pa.array(texts, pa.string()), 2)
    want = [ids_of(path, t) + [2] for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == want


OTHER_SCRIPTS = [
    "Съешь же ещё этих мягких французских булок, да выпей чаю. " * 50,
    "\u201cIt\u2019s fine\u201d \u2014 they\u2019ve said, don't  we?\u3000 \n\n x\u00a0 y \U0001f600\U0001f600 " * 50,
    "日本語の文章です。 中文 字符 " * 50 + "<|endoftext|> H\u0331 J\u030c ΟΔΟΣ İ \ue000a <|end <|startoftext|>tail ",
    "plain words between",
    "",
]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_units_of_other_scripts(path):
    encoder, texts = pieces(path), pa.array(OTHER_SCRIPTS)
    ids, offsets = encoder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [ids_of(path, t) for t in OTHER_SCRIPTS]
    units, bounds = encoder.units(texts)
    assert len(bounds) == len(texts) + 1 and bounds[-1] == len(units)
    assert max(map(len, units.to_pylist())) <= 60 and len(set(units.to_pylist())) < 120


def test_cache_is_bounded_by_bytes(monkeypatch):
    import curvelab.llm.pieces as module

    monkeypatch.setattr(module, "CACHED_BYTES", 2000)
    encoder = module.Pieces(BYTE)
    for k in range(50):
        text = " ".join(f"слово{k}x{j}" for j in range(10))
        assert encoder.encode(pa.array([text]))[0].tolist() == ids_of(BYTE, text)
        assert encoder.held < 4000 and len(encoder.codes) < 200


def test_sliced_batches(table):
    text = table("documents").select("text").toArrow().column("text").combine_chunks().slice(50, 60)
    ids, offsets = pieces(BYTE).encode(text)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [ids_of(BYTE, t) for t in text.to_pylist()]


def test_forgetting_changes_nothing(table, monkeypatch):
    import curvelab.llm.pieces as module

    monkeypatch.setattr(module, "CACHED_UNITS", 50)
    encoder = module.Pieces(WORD)
    for r in table("documents").limit(20).collect():
        assert encoder.encode(pa.array([r["text"]]))[0].tolist() == ids_of(WORD, r["text"])


@pytest.mark.parametrize("which", ["table", "edges"])
def test_token_counts(which, table, edge_docs):
    docs = table("documents") if which == "table" else edge_docs
    got = sorted(map(tuple, token_counts.count_tokens(docs, WORD, chunk_bytes=100_000).collect()), key=str)
    want = [(r["doc_id"], len((r["text"] or "").encode()), len(ids_of(WORD, r["text"]))) for r in docs.collect()]
    assert got == sorted(want, key=str)


def test_token_counts_empty(no_docs):
    assert token_counts.count_tokens(no_docs, WORD).count() == 0


@pytest.mark.parametrize("which", ["table", "edges"])
def test_token_files(which, table, edge_docs):
    docs = table("documents") if which == "table" else edge_docs
    manifest, folder = token_files.token_files(docs, BYTE)
    got = [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], r["ids"]) for r in token_files.read_token_files(manifest, folder).collect()]
    rows = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or "") for r in docs.collect()))
    want, start = [], 0
    for known, doc, _, text in rows:
        ids = ids_of(BYTE, text) + [2]
        want.append((doc if known else None, start, len(ids), crc(ids), ids))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want


def test_token_files_empty(no_docs):
    manifest, folder = token_files.token_files(no_docs, BYTE)
    assert token_files.read_token_files(manifest, folder).count() == 0


def check_packing(docs, capacity, grain):
    cut, placed = packing.pack(docs, WORD, 2, capacity, grain)
    keyed = {(r["part"], r["piece"]): r for r in cut.collect()}
    digest = {(r["part"], r["piece"]): r["ids_crc32"] for r in packing.piece_digests(cut).collect()}
    rows = placed.collect()
    assert len(rows) == len(keyed) == len(digest)
    got, sequences = [], {}
    for r in rows:
        piece = keyed[r["part"], r["piece"]]
        ids = np.frombuffer(piece["ids"], f"<u{piece['width']}").tolist()
        assert len(ids) == r["length"] and digest[r["part"], r["piece"]] == crc(ids)
        got.append((r["doc_id"], r["start"], r["doc_tokens"], ids))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["sequence_tokens"]))
    for inside in sequences.values():
        at = 0
        for offset, length, total in sorted(inside):
            assert offset == at
            at += length
        assert at <= capacity and {t for _, _, t in inside} == {at}
    want = []
    for r in docs.collect():
        ids = ids_of(WORD, r["text"]) + [2]
        want += [(r["doc_id"], s, len(ids), ids[s : s + capacity]) for s in range(0, len(ids), capacity)]
    assert sorted(got, key=str) == sorted(want, key=str)
    return len(sequences), sum(len(g[3]) for g in got)


def test_packing(table):
    sequences, tokens = check_packing(table("documents"), 4096, 16)
    assert tokens > 0.95 * 4096 * sequences


@pytest.mark.parametrize("words", [1, 2, 6, 16])
def test_short_documents_fill_their_sequences(spark, words):
    """A corpus of documents of a few ids: 95 % of the places are filled, the last sequence apart."""
    docs = spark.createDataFrame([(i, " ".join(["the"] * words)) for i in range(20_000 // words)], "doc_id long, text string")
    _, placed = packing.pack(docs, WORD, 2)
    tokens, sequences = placed.agg({"length": "sum"}).first()[0], placed.select("sequence_id").distinct().count()
    assert sequences <= -(-tokens // int(0.95 * 4096)), (tokens, sequences)


def test_bundles():
    ranges, units = packing.bundles({2: 21, 5: 40, 16: 3, 256: 2, 272: 7, 4096: 1}, 4096, 16)
    assert units == {1: 2 + 5 + 3 + 8, 5: 2, 16: 2, 17: 7, 256: 1}
    covered = {}
    for size, begin, end, grains, each, _ in ranges:
        assert begin == covered.get(size, 0) and (end - begin) % each == 0 and each * size <= 16 * grains
        covered[size] = end
    assert covered == {2: 21, 5: 40, 16: 3, 256: 2, 272: 7, 4096: 1}


def test_packing_edges(edge_docs, no_docs):
    check_packing(edge_docs, 64, 4)
    cut, placed = packing.pack(no_docs, WORD)
    assert placed.count() == 0
    with pytest.raises(ValueError):
        packing.pack(no_docs, WORD, capacity=100, grain=16)


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(0, 60), max_size=20))
def test_plan_holds_the_demand(demand):
    held: dict[int, int] = {}
    sequences = 0
    for counts, times in cutting_stock.plan(demand, 32):
        assert sum(s * n for s, n in counts.items()) <= 32 and times > 0
        sequences += times
        for s, n in counts.items():
            held[s] = held.get(s, 0) + n * times
    assert held == {s: n for s, n in demand.items() if n}
    # first-fit decreasing by hand is no better by more than the rounding
    bins: list[int] = []
    for s in sorted((s for s, n in demand.items() for _ in range(n)), reverse=True):
        for i, room in enumerate(bins):
            if room >= s:
                bins[i] -= s
                break
        else:
            bins.append(32 - s)
    assert sequences <= len(bins) + max(2, len(held))


def test_linear_program_reaches_the_bound():
    # 1 and 3 quarters fill sequences exactly
    patterns, uses = cutting_stock.solve(np.array([8, 24]), np.array([100.0, 100.0]), 32)
    assert abs(uses.sum() - 100) < 1e-6
