"""Lexicon encoding, whitening and the source audit against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict
from fractions import Fraction
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from contrail.llm import lexicon_bpe, source_audit, whitening
from contrail.llm.queries import op11_whitening
from contrail.llm.tokens import tokenizer_path
from contrail.llm.transducer import Transducer, compile_words

# the transducer


def machine(tmp_path, words) -> Transducer:
    (tmp_path / "words.bin").write_bytes(compile_words(words))
    return Transducer(str(tmp_path / "words.bin"))


def test_transducer_gives_every_output_and_knows_nothing_else(tmp_path):
    r = random.Random(1)
    words = {bytes(r.choice(b"abc\x00\xff") for _ in range(r.randint(1, 9))): tuple(r.randint(0, 5) for _ in range(r.randint(0, 4))) for _ in range(3000)}
    own = machine(tmp_path, words.items())
    others = [w for w in (bytes(r.choice(b"abc\x00\xff") for _ in range(r.randint(0, 10))) for _ in range(2000)) if w not in words]
    assert own.look_up(list(words)) == [list(x) for x in words.values()]
    assert own.look_up([b"", *others]) == [None] * (1 + len(others))


def test_transducer_shares_endings_and_may_be_empty(tmp_path):
    stems = [b"walk", b"talk", b"jump", b"call", b"fill"]
    own = machine(tmp_path, [(s + e, (i, 900 + j)) for i, s in enumerate(stems) for j, e in enumerate([b"", b"s", b"ed", b"ing"])])
    assert own.n_states < 4 * len(stems) + 8  # each stem once, the endings once for all
    assert machine(tmp_path, []).look_up([b"a", b""]) == [None, None]
    with pytest.raises(ValueError):
        compile_words([(b"a", ()), (b"a", ())])
    with pytest.raises(ValueError):
        compile_words([(b"", ())])


# encoding

PARTS = ["a", "b c", " ", "\n", "é", "'s", "1", "-", " the", "漢", "\r", "<|endoftext|>", "Ġ", "\x1c", "　", "\x85", "x" * 50, "ab" * 40, "🙂", "‍"]


def awkward(r, n):
    return ["", " ", "x  y", "a\n b", "　a b", " <|endoftext|> "] + ["".join(r.choice(PARTS) for _ in range(r.randint(0, 14))) for _ in range(n)]


def test_encoder_gives_the_librarys_ids_with_any_lexicon(tmp_path):
    r = random.Random(2)
    library, merges = Tokenizer.from_file(tokenizer_path()), lexicon_bpe.merge_list(tokenizer_path())
    known = [" the", " lake", "the", " x\ny", " é", "c"]
    lexicon = machine(tmp_path, [(w.encode(), tuple(i)) for w, i in zip(known, merges.encoded(known), strict=True)])
    texts = awkward(r, 500)
    for own in (lexicon_bpe.LexiconEncoder(merges, lexicon, remembered=40), lexicon_bpe.LexiconEncoder(merges, None)):
        for at in range(0, len(texts), 60):
            part = texts[at : at + 60]
            expected = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
            got = [e.tolist() for e in own.encode(part)]
            assert got == expected
            assert list(map(merges.decoded, got)) == library.decode_batch(expected, skip_special_tokens=False) == part
    assert own.encode([]) == []


def test_long_pieces_merge_as_short_ones_do():
    r = random.Random(3)
    merges = lexicon_bpe.merge_list(tokenizer_path())
    pieces = [bytes(r.choice(b"aethinosr") for _ in range(r.randint(0, lexicon_bpe.LONG_PIECE))) for _ in range(400)]
    assert merges.merged(pieces) == [merges._merged_by_queue(p) for p in pieces]
    assert merges.merged([]) == []


def test_documents_are_encoded_whole(spark):
    r = random.Random(4)
    library = Tokenizer.from_file(tokenizer_path())
    rows = [(i, t) for i, t in enumerate(awkward(r, 60))] + [(900, None), (901, "long " * 9000), (902, "y" * 20_000), (902, "y" * 20_000), (None, "no id")]
    docs = spark.createDataFrame([(i, t, "f", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(3)
    expected = Counter()
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        expected[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(said.encode()).hexdigest()] += 1
    lexicon = lexicon_bpe.build_lexicon(docs, words=20, frequent=1)
    assert Counter(map(tuple, lexicon_bpe.encoding_digests(docs, lexicon=lexicon).collect())) == expected
    whole = {x.doc_id: x for x in lexicon_bpe.encode_documents(docs, lexicon=lexicon).collect()}
    assert all(whole[i].decoded == (t or "") for i, t in rows) and whole[900].ids == []
    assert lexicon_bpe.encoding_digests(docs.limit(0)).count() == 0


def test_word_counts_cover_all_texts(spark):
    docs = spark.createDataFrame([(1, "a b  c a"), (2, "a a"), (3, None)], "doc_id long, text string").repartition(3)
    assert {r.word: r.n for r in lexicon_bpe.word_counts(docs).collect()} == {"a": 2, " b  c": 1, " a": 2, "": 1}


# whitening


def brute_whitening(vectors, k):
    """Exact sums, then numpy: n, deviations, whitened values up to sign, shares."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    total = [sum(v[i] for v in x) for i in range(d)]
    y = [[n * v[i] - total[i] for i in range(d)] for v in x]
    cov = np.array([[float(Fraction(sum(a[i] * a[j] for a in y), n**3)) for j in range(d)] for i in range(d)])
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(-values)[:k]
    white = np.array([[float(Fraction(a, n)) for a in v] for v in y]) @ axes[:, order] / np.sqrt(values[order])
    return n, [sum(a * a for a in v) for v in y], white, values[order] / np.trace(cov)


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, "e") for i, v in rows], "vec_id long, embedding array<float>, n string").repartition(3)


def test_whitening_matches_exact_covariances(spark):
    r = np.random.default_rng(5)
    spread = r.normal(size=(60, 7)) @ np.diag([9, 5, 3, 2, 1.5, 1, 0.7])
    good = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(spread)]
    good += [(70, good[0][1]), (70, good[0][1]), (None, good[1][1])]
    bad = [(80, None), (81, [1.0] * 6 + [None]), (82, [float("nan")] * 7), (83, [float("inf")] * 7), (84, [1.0, 2.0]), (85, [])]
    n, deviations, white, shares = brute_whitening([v for _, v in good], 5)
    got = whitening.whiten(vectors_of(spark, good + bad), components=5).toPandas()
    assert len(got) == 5 * len(good) and set(got["n"]) == {n} and set(got["component"]) == {1, 2, 3, 4, 5}
    expected = Counter((i, d) for (i, _), d in zip(good, deviations, strict=True))
    assert Counter((None if np.isnan(i) else int(i), int(d)) for i, d in zip(got["vec_id"][got["component"] == 1], got["deviation"][got["component"] == 1], strict=True)) == expected
    for k in range(5):
        own = got[got["component"] == k + 1].dropna().drop_duplicates("vec_id").set_index("vec_id")
        theirs = {i: w for (i, _), w in zip(good, white[:, k], strict=True) if i is not None}
        sign = np.sign(own.loc[0, "whitened"] * theirs[0])
        assert np.allclose([own.loc[i, "whitened"] * sign for i in theirs], list(theirs.values()), atol=1e-9)
        assert np.allclose(own["explained"], shares[k], rtol=1e-9)
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-9


def test_square_sums_are_exact_at_every_size():
    r = random.Random(6)
    for bits in (3, 20, 31, 40, 58):
        rows = [[r.randint(-(2**bits), 2**bits) for _ in range(5)] for _ in range(50)]
        for y in (np.asarray(rows, dtype=np.int64), np.asarray(rows, dtype=object)):
            assert whitening.square_sums(y).tolist() == [sum(v[i] ** 2 for v in rows) for i in range(5)]
            assert whitening.square_sums(y, axis=1).tolist() == [sum(c * c for c in v) for v in rows]


def test_centring_is_exact_for_huge_entries():
    rows = [[2**62, 5, -(2**62)], [1, 6, -(2**62)], [-(2**60), 7, 3]]
    total = [sum(v[i] for v in rows) for i in range(3)]
    assert whitening.centred(np.asarray(rows, dtype=np.int64), 3, total).tolist() == [[3 * v[i] - total[i] for i in range(3)] for v in rows]


def test_whitening_of_odd_tables(spark):
    assert whitening.whiten(vectors_of(spark, [])).count() == 0
    assert whitening.whiten(vectors_of(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten(vectors_of(spark, [(1, [1.0, 2.0])] * 3)).count() == 0  # no variance, no component
    flat = whitening.whiten(vectors_of(spark, [(i, [float(i), 2.0]) for i in range(4)])).toPandas()
    assert set(flat["component"]) == {1} and np.allclose(flat["explained"], 1)  # the constant dimension has none
    large = whitening.whiten(vectors_of(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 4.0])])).toPandas()
    assert set(large["component"]) == {1} and large["identity_error"].max() < 1e-9


def test_whitening_query_has_the_columns_asked_for(spark):
    got = op11_whitening(spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes) == {
        "vec_id": "bigint",
        "component": "int",
        "n": "bigint",
        "deviation": "bigint",
        "whitened": "double",
        "explained": "double",
        "identity_error": "double",
    }


# the source audit


def brute_divergence(rows, least, top):
    def terms(text):
        return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(source_audit.TERM, text or "")]

    docs = [(lang or "", source or "", Counter(terms(text))) for text, lang, source in rows]
    groups, out = {(a, b) for a, b, _ in docs}, set()
    for lang in {a for a, _ in groups}:
        holders = Counter(t for a, _, c in docs if a == lang for t in c)
        kept = [t for t, n in holders.items() if n >= least]
        count = defaultdict(Counter)
        for a, source, c in docs:
            if a == lang:
                for t in kept:
                    count[source][t] += c[t]
                    count[None][t] += c[t]
        sources = [b for a, b in groups if a == lang]

        def share(source, t):
            return 1 + 10**9 * (count[source][t] + 5) // (sum(count[source][x] for x in kept) + 5 * len(kept))

        for s in sources:
            pairs = [(-sum(abs(share(s, t) - share(o, t)) for t in kept), o.encode(), o) for o in sources if o != s]
            out |= {(lang, s, "pair", o, -v, k) for k, (v, _, o) in enumerate(sorted(pairs), 1)}
            over = [(share(None, t) - share(s, t), t.encode(), t) for t in kept if count[s][t] and share(s, t) > share(None, t)]
            out |= {(lang, s, "term", t, -v, k) for k, (v, _, t) in enumerate(sorted(over)[:top], 1)}
    return out


@pytest.mark.parametrize("entries", [1, 400, 10**9])
def test_divergence_matches_brute_force(spark, monkeypatch, entries):
    r = random.Random(7)
    words = ["The", "the,", "(the)", "lake", "Äpfel", "äpfel-Lake", "12", "x1y", "a.b", "漢字", "é", "stone", "…"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(" ".join(r.choices(words, k=r.randint(0, 30))), r.choice(["en", "de", None]), r.choice(["s", "t", "u", None])) for _ in range(120)]
    rows += [(None, "en", "s"), ("", "fr", "only"), (" \n\t ", "it", "a"), ("rare", "it", "b"), ("the " * 9000, "en", "t")] + [("copy Copy copy", "en", "u")] * 6
    docs = spark.createDataFrame([(i % 9 or None, *x, 1, "c") for i, x in enumerate(rows)], "doc_id long, text string, lang string, source string, n int, chunk string")
    monkeypatch.setattr(source_audit, "BLOCK_ENTRIES", entries)
    blocks = source_audit.chunk_blocks
    monkeypatch.setattr(source_audit, "chunk_blocks", lambda d: blocks(d, entries))
    got = source_audit.source_divergence(docs.repartition(3), min_documents=5, top_terms=4)
    assert set(map(tuple, got.collect())) == brute_divergence(rows, 5, 4)
    assert got.count() == len(brute_divergence(rows, 5, 4))


def test_divergence_of_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert source_audit.source_divergence(none).count() == 0
    bare = spark.createDataFrame([(1, None, None, None), (2, "a", "en", "s"), (3, "a", "en", "t")], none.schema)
    got = source_audit.source_divergence(bare)
    assert {tuple(x) for x in got.collect()} == {("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)}


def test_chunks_are_cut_once_and_hopeless_terms_left_out(spark):
    rows = [("a,B", 2), ("a,B", 1), ("12", 9), ("é-É", 3), ("b-b", 1), ("c", 3), ("c!", 1), ("d", 3)]
    chunks = spark.createDataFrame(rows, "chunk string, holders int")
    got = {(x.chunk, x.term, x.k) for x in source_audit.chunk_terms(chunks, 4).collect()}
    assert got == {("a,B", "b", 1), ("b-b", "b", 2), ("c", "c", 1), ("c!", "c", 1)}


def test_chunks_of_a_block_are_read_in_place(spark):
    """Each chunk comes with its own holders, and no array of pairs is built on the way."""
    blocks = spark.createDataFrame([(0, ["a", "b"], [3, 1]), (1, ["b"], [2]), (2, [], [])], "block long, chunks array<string>, holders array<int>")
    held = source_audit.held_chunks(blocks)
    assert sorted(map(tuple, held.collect())) == [("a", 3), ("b", 1), ("b", 2)]
    assert "arrays_zip" not in held._jdf.queryExecution().toString()


def test_blocks_are_stored_and_spelled_out_piece_by_piece(spark, monkeypatch):
    docs = spark.createDataFrame([(f"w{i % 50} x{i} common w{i % 7}", "en", f"s{i % 3}") for i in range(40)], "text string, lang string, source string").coalesce(1)
    blocks = source_audit.stored_blocks(source_audit.chunk_blocks(docs, 1))
    files = [pq.ParquetFile(f).metadata for f in Path(blocks._scratch.removeprefix("file:")).glob("*.parquet")]
    assert blocks.count() == sum(f.num_row_groups for f in files)
    n_docs, width = 2000, 100
    rng = np.random.default_rng(3)
    ids = np.sort(rng.integers(0, 5000, (n_docs, width)), axis=1)
    steps = np.diff(ids.ravel(), prepend=0).astype(np.int32).view(np.int16).reshape(-1, 2)
    lists = {"langs": ["en", "de"], "places": [0, 0], "doc_group": rng.integers(0, 2, n_docs).astype(np.int32), "doc_size": np.full(n_docs, width, np.int32)}
    lists |= {"low": steps[:, 0].copy(), "high": steps[:, 1].copy(), "counts": rng.integers(1, 5, n_docs * width).astype(np.int32)}
    counted = pa.table({"block": [0]} | {k: pa.array([v]) if isinstance(v, list) else pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v)) for k, v in lists.items()})
    found = pa.table({"pos": pa.array(np.arange(5000), pa.int32()), "term": [f"t{i % 900}" for i in range(5000)], "k": pa.array(np.ones(5000), pa.int32())})
    made = {}
    for size in (5_000, 10**9):
        monkeypatch.setattr(source_audit, "SLICE_ENTRIES", size)
        tracemalloc.start()
        made[size] = source_audit._block_terms(counted, found), tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
    (small, peak), (whole, most) = made.values()
    assert small.equals(whole) and sum(map(sum, small["n"].to_pylist())) == lists["counts"].sum()
    assert peak < most / 2
