"""The text operators against brute force, on small tables with nulls, ties, repeats, long texts and clashing columns."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from contrail.llm import chunk_dedup, decontaminate, grouping, line_dedup, minhash, packing, pii, substring, token_scan, toxicity, training_order
from contrail.llm.common import forget
from contrail.llm.components import components
from contrail.llm.tokens import RANKS, WordTokenizer, tokenizer_path
from contrail.session import settle

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, kept boolean, n_words long, component_id long, file string"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (id, text), among columns that the operators use names of."""
    return lambda *rows: spark.createDataFrame([(i, t, None, 1, None, "f") for i, t in rows], SCHEMA)


def rows(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def sentence(r, words="the of lake stone river bright tall green cold old".split(), n=40):
    return " ".join(r.choice(words) for _ in range(n))


ODD = [(1, None), (2, ""), (3, "  \n "), (4, "one"), (5, "one"), (None, "one"), (6, "x" * 30_000), (7, "a b " * 4000), (7, "a b " * 4000)]


@pytest.mark.parametrize(
    "run",
    [
        packing.pack,
        line_dedup.line_duplicates,
        line_dedup.remove_duplicate_lines,
        chunk_dedup.exact_duplicates,
        training_order.training_order,
        minhash.near_duplicates,
        substring.remove_repeats,
        pii.personal_spans,
        pii.sanitise,
        lambda d: token_scan.document_tokens(token_scan.token_stream(d)),
        token_scan.token_file_scan,
        lambda d: decontaminate.contamination(d, d.select(F.col("doc_id").alias("item_id"), "text").limit(0)),
        lambda d: toxicity.toxicity(d, d.select("doc_id", F.lit(1).alias("toxic")).limit(0)),
    ],
)
def test_odd_and_empty_tables(docs, run):
    assert run(docs()).count() == 0
    assert run(docs(*ODD)).collect() is not None


# tokens and packing


def test_word_cache_gives_the_tokenizers_ids():
    r = random.Random(1)
    own = WordTokenizer(tokenizer_path(), cache_words=50)
    parts = ["a", "b c", " ", "\n", "é", "'s", "1", "-", " the", "漢", "\r", "<|endoftext|>", "Ġ"]
    texts = ["", " ", "x  y", "a\n b", "　a b"] + ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(400)]
    for at in range(0, len(texts), 40):
        part = texts[at : at + 40]
        expected = [e.ids for e in own.tokenizer.encode_batch(part, add_special_tokens=False)]
        assert [e.tolist() for e in own.encode(part)] == expected


def test_a_rank_file_gives_the_same_ids_within_its_bytes():
    r = random.Random(3)
    whole = WordTokenizer(tokenizer_path()).tokenizer
    whole.encode_special_tokens = True
    own = WordTokenizer("", plain=tokenizer_path(RANKS), cache_bytes=20_000)
    for turn in range(20):
        texts = [" ".join(r.choice(["lake", "stone's", "x" * r.randint(1, 900), "漢字", "<|endoftext|>", f"{r.random()}"]) for _ in range(30)) for _ in range(5)]
        assert [e.tolist() for e in own.encode(texts)] == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
        assert turn == 0 or own.held < 20_000 + 150 * 1500


def check_packed(pieces, texts, window):
    tokenizer = WordTokenizer(tokenizer_path()).tokenizer
    by_doc = {i: g.sort_values("start") for i, g in pieces.groupby("doc_id")}
    for i, text in texts:
        ids = np.asarray([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for p in by_doc[i].itertuples():
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for _, g in pieces.sort_values("offset").groupby("sequence_id"):
        assert g["offset"].tolist() == [0, *np.cumsum(g["length"])[:-1]] and g["length"].sum() <= window


def test_packing_keeps_every_id_once(docs):
    r = random.Random(2)
    texts = [(i, sentence(r, n=r.randint(0, 300))) for i in range(150)] + [(500, None), (501, "long " * 5000)]
    pieces = packing.pack(docs(*texts).repartition(6), window=128, open_windows=3, merged_partitions=4).toPandas()
    check_packed(pieces, texts, 128)
    assert pieces["length"].sum() / (128 * pieces["sequence_id"].nunique()) > 0.95


def test_open_windows_place_best_fit_and_emit_the_fullest():
    w = packing.OpenWindows(10, 2, 0)
    assert w.place(6) == (0, 0) and w.place(7) == (1, 0)
    assert w.place(3) == (1, 7)  # fits the fuller one exactly
    assert w.place(5) == (2, 0) and w.place(6) == (3, 0)  # none fits: sequence 0, the fullest, goes
    assert {s for _, s in w.free} == {2, 3}


# lines


def test_band_distance_is_exact():
    r = random.Random(3)
    for edits in (1, 2, 3):
        a, b = [], []
        for _ in range(600):
            x = "".join(r.choice("abé") for _ in range(r.randint(0, 20)))
            y = list(x)
            for _ in range(r.randint(0, edits + 2)):
                at = r.randint(0, len(y))
                y[at : at + r.randint(0, 1)] = r.choice(["", "a", "b"])
            a.append(x)
            b.append("".join(y))
        assert line_dedup.within(a, b, edits).tolist() == [line_dedup._distance(x, y) <= edits for x, y in zip(a, b, strict=True)]


@pytest.mark.parametrize("edits", [1, 2])
def test_line_classes(docs, edits):
    r = random.Random(4)
    base = ["".join(r.choice("abcdef ") for _ in range(r.randint(16, 30))) for _ in range(25)]

    def changed(line):
        for _ in range(r.randint(0, edits + 1)):
            at = r.randrange(len(line))
            line = line[:at] + r.choice(["", "x", "yz"]) + line[at + r.randint(0, 1) :]
        return line

    texts = [(i, "\n".join(changed(r.choice(base)) for _ in range(6)) + "\nshort") for i in range(40)]
    lines = [(i, n, line) for i, t in texts for n, line in enumerate(t.split("\n")) if len(line) >= 16]
    distinct = sorted({x for _, _, x in lines})
    parent = {x: x for x in distinct}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in itertools.combinations(distinct, 2):
        if line_dedup._distance(x, y) <= edits:
            parent[root(x)] = root(y)
    groups = {}
    for i, n, line in lines:
        groups.setdefault(root(line), []).append((i, n))
    expected = {p: (len(g), min(g)[0], p == min(g)) for g in groups.values() if len(g) > 1 for p in g}
    got = {(x.doc_id, x.line_no): (x.class_size, x.first_doc_id, x.kept) for x in line_dedup.line_duplicates(docs(*texts), edits).collect()}
    assert got == expected
    cleaned = rows(line_dedup.remove_duplicate_lines(docs(*texts), edits))
    for i, t in texts:
        kept = [line for n, line in enumerate(t.split("\n")) if expected.get((i, n), (0, 0, True))[2]]
        assert cleaned[i]["text"] == "\n".join(kept) and cleaned[i]["file"] == "f"


def test_short_lines_are_exact_repeats(docs, spark):
    texts = [(1, "Les.\n\nA line that is long enough to probe.\nYes"), (2, "No.\n \nYes"), (3, "Les.\n\nA line that is long enough to probe.\nYes"), (4, "Les!\nNo.\nNo."), (5, None), (6, "\n")]
    lines = [(i, n, line) for i, t in texts for n, line in enumerate((t or "").split("\n")) if line.strip()]
    groups = {}
    for i, n, line in lines:
        groups.setdefault(line, []).append((i, n))
    expected = {p: (len(g), min(g)[0], p == min(g)) for g in groups.values() if len(g) > 1 for p in g}
    got = {(x.doc_id, x.line_no): (x.class_size, x.first_doc_id, x.kept) for x in line_dedup.line_duplicates(docs(*texts), short=True).collect()}
    assert got == expected
    left = rows(corpus_pipeline.drop_repeated_lines(spark, docs(*texts), ""))
    assert {i: x["text"] for i, x in left.items()} == {1: texts[0][1], 2: "No.\n ", 4: "Les!", 5: None, 6: "\n"}


def test_near_lines_by_their_length(docs):
    r = random.Random(14)
    words = "of thou wolde haouble esing erly table stone 1234 lake".split() + [f"w{i}" for i in range(60)]
    lines = []
    for n in (3, 5, 6, 8, 12, 19, 20, 25, 33, 60):
        base = [r.choice(words) for _ in range(n)]
        for k in range(n // 10 + 3):
            copy = list(base)
            for i in r.sample(range(n), min(k, n)):
                copy[i] = r.choice(["", "replacement", copy[i] + "x", copy[i] + " y"])
            lines.append(" ".join(copy))
    lines += ["the number is 12 of these ones", "the number is 47 of these ones", "nothing like the other lines at all", "fifteen chars a", "fifteen chars ab"]
    texts = list(enumerate(lines))

    def linked(x, y):
        n, k = min(len(x), len(y)), min(len(x.split()), len(y.split()))
        chars = 3 if n >= 30 else 2 if n >= 20 else 1 if n >= 16 else 0
        ws = k // 10 if k >= 20 else 1 if k >= 6 else -1
        near = abs(len(x.split()) - len(y.split())) <= ws and line_dedup._distance(x.split(), y.split()) <= ws
        return near or abs(len(x) - len(y)) <= chars and line_dedup._distance(x, y) <= chars

    pairs = list(itertools.combinations(range(len(lines)), 2))
    expected = [linked(lines[a], lines[b]) for a, b in pairs]
    assert line_dedup.alike([lines[a] for a, _ in pairs], [lines[b] for _, b in pairs], None).tolist() == expected
    group = list(range(len(lines)))
    for (a, b), link in zip(pairs, expected, strict=True):
        if link:
            group = [group[a] if g == group[b] else g for g in group]
    want = {i: (group.count(g), group.index(g)) for i, g in enumerate(group) if group.count(g) > 1}
    got = {x.doc_id: (x.class_size, x.first_doc_id) for x in line_dedup.line_duplicates(docs(*texts), short=True).collect()}
    assert got == want and len(lines) - 5 in got


def test_linked_lines_have_a_key_in_common():
    """Four to six edits in long lines without blanks or with few; words changed in lines of any number."""
    r = random.Random(5)
    pairs = []
    for length, edits in itertools.product((596, 598, 602, 640, 760, 1000), range(3, 7)):
        for gap in (0, 40, 90):
            x = "".join(" " if gap and r.random() < 1 / gap else r.choice("abcdefgh") for _ in range(length))
            y = x
            for _ in range(edits):
                at = r.randrange(len(y))
                y = y[:at] + r.choice(["", "z", " "]) + y[at + r.randint(0, 1) :]
            pairs.append((x, y))
    for n in range(4, 80):
        x = [r.choice("of the stone lake table thou wolde a erly".split()) for _ in range(n)]
        y = list(x)
        for i in r.sample(range(n), max(1, n // 10)):
            y[i] = r.choice(["", "replaced", x[i] + "x", x[i] + " y"])
        pairs.append((" ".join(x), " ".join(y)))
    linked = line_dedup.alike([x for x, _ in pairs], [y for _, y in pairs], None).tolist()
    assert sum(linked[:72]) >= 30 and sum(linked[72:]) >= 50
    for (x, y), link in zip(pairs, linked, strict=True):
        line, key = line_dedup.line_keys([x, y], None)
        assert not link or len(x) < line_dedup.MIN_CHARS or set(key[line == 0].tolist()) & set(key[line == 1].tolist())


@pytest.fixture()
def passage_lines():
    """Lines that hold one passage and nothing else in common, and two that are linked."""
    random = np.random.default_rng(5)
    word = lambda: "".join(random.choice(list("abcdefghijklmnop"), 6))
    passage = [word() + "longest" for _ in range(7)]
    lines = [" ".join([*(word() for _ in range(20)), *passage, *(word() for _ in range(20))]) for _ in range(60)]
    return [*lines, lines[0].rsplit(" ", 1)[0] + " other"]


def test_lines_of_a_passage_meet_only_if_linked(spark, passage_lines):
    lines = spark.createDataFrame(list(enumerate(passage_lines)), "doc long, line string")
    line, key = line_dedup.line_keys(passage_lines, None)
    every = line_dedup.meeting(spark.createDataFrame([*zip(line.tolist(), key.tolist(), strict=True)], "doc long, band long"))
    assert every.select("doc").distinct().count() == 61
    left = line_dedup.meeting(line_dedup.rarer_keys(every, lines, None))
    assert {r.doc for r in left.select("doc").distinct().collect()} == {0, 60}
    docs = spark.createDataFrame(list(enumerate(passage_lines)), "doc_id long, text string")
    assert {r.doc_id for r in line_dedup.line_duplicates(docs).collect()} == {0, 60}


def test_linked_lines_share_a_key_whatever_is_common():
    random = np.random.default_rng(6)
    for n in (8, 25, 60):
        x = [str(random.integers(10**6)) for _ in range(n)]
        for _ in range(20):
            y = list(x)
            for i in random.choice(n, line_dedup.allowed_words(n), replace=False):
                y[i] = str(random.integers(10**6))
            pair = [" ".join(x), " ".join(y)]
            _, key = line_dedup.line_keys(pair, None)
            common = np.unique(random.choice(key, len(key) // 2, replace=False))
            line, key = line_dedup.line_keys(pair, None, common)
            assert set(key[line == 0]) & set(key[line == 1])


def test_words_are_cut_as_split_does():
    odd = ["a b\x1cc\xa0d", "", "   ", "\u3000x" * 4, "\ud800 b\x85", "üöß \u2003 ñ"]
    names, sizes, counts = line_dedup.word_hashes(odd)
    words = [w for line in odd for w in line.split()]
    assert counts.tolist() == [len(line.split()) for line in odd] and sizes.tolist() == list(map(len, words))
    assert len(set(zip(words, names.tolist(), strict=True))) == len(set(words)) == len(set(names.tolist()))


@pytest.mark.parametrize("cell", [4, 8192])
def test_near_pairs_are_all_that_may_be_linked(spark, monkeypatch, cell):
    monkeypatch.setattr(line_dedup, "CELL", cell)
    random = np.random.default_rng(7)
    base = [str(random.integers(1000)) for _ in range(30)]
    lines = []
    for _ in range(25):
        y = list(base)
        for i in random.choice(30, random.integers(0, 6), replace=False):
            y[i] = str(random.integers(1000))
        lines.append(" ".join(y))
    lines = list(dict.fromkeys(lines))
    facts = line_dedup.measures(spark.createDataFrame(list(enumerate(lines)), "doc long, line string")).drop("line")
    members = spark.createDataFrame([(band, i, i % 5) for band in (1, 2) for i in range(len(lines))], "band long, doc long, label long")
    found = {(r.a, r.b) for r in line_dedup.near_pairs(members, facts, None, False).collect()}
    every = [(a, b) for a in range(len(lines)) for b in range(a + 1, len(lines)) if a % 5 != b % 5]
    linked = line_dedup.alike([lines[a] for a, _ in every], [lines[b] for _, b in every], None)
    assert {p for p, near in zip(every, linked, strict=True) if near} <= found <= set(every)
    best = line_dedup.near_pairs(members, facts, None, True).collect()
    assert {(r.a, r.b) for r in best} <= found and {(r.label, r.label_b) for r in best} == {(r.a % 5, r.b % 5) for r in best}


def test_a_document_goes_only_if_one_earlier_one_holds_it(docs, spark):
    a, b, c = "First line of some length, alone.", "Second thing, which is quite other.", "Third of them: nothing like those."
    texts = [(1, f"{a}\nx"), (2, f"{b}\n{c}"), (3, f"{a}\n\n{b}"), (4, f"{b}\n{a}"), (5, c), (6, "x"), (7, f"x\n{c}"), (8, "\n"), (9, None), (None, a)]
    left = {x.doc_id: x.text for x in corpus_pipeline.drop_repeated_lines(spark, docs(*texts), "").collect()}
    sets = {i: {x for x in (t or "").split("\n") if x} for i, t in texts if i}
    kept = [i for i, s in sets.items() if not s or not any(j < i and s <= sets[j] for j in sets)]
    assert left == {i: t for i, t in texts if i in (None, *kept)} and kept == [1, 2, 3, 7, 8, 9]


# equal and near documents


def test_chunks_make_up_the_text(spark):
    texts = ["", "a", "word. " * 500, "x" * 10_000, "é\n" * 700, "no end"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", chunk_dedup.chunks(F.col("text")).alias("c"))
    assert all("".join(r.c) == r.text for r in df.collect())


def test_equal_texts_keep_the_largest_id(docs):
    got = rows(chunk_dedup.exact_duplicates(docs((1, "a" * 900), (2, "a" * 900), (3, "a" * 901), (4, None), (5, ""), (9, "a" * 900))))
    assert {i: (g["keep_id"], g["group_size"], g["kept"]) for i, g in got.items()} == {
        1: (9, 3, False), 2: (9, 3, False), 9: (9, 3, True), 3: (3, 1, True), 4: (5, 2, False), 5: (5, 2, True)
    }
    assert got[4]["text_sha256"] == hashlib.sha256(b"").hexdigest()


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 11), (11, 12), (12, 3), (20, 21), (21, 20), (30, 30)]
    found = components(spark.createDataFrame(links, "a long, b long").repartition(4))
    assert {r.node: r.component for r in found.collect()} == {1: 1, 2: 1, 3: 1, 10: 1, 11: 1, 12: 1, 20: 20, 21: 20}


def test_superminhash_estimates_similarity():
    r = np.random.default_rng(5)
    for n in (10, 200, 3000):
        shares = []
        for _ in range(40):
            a = np.unique(r.integers(0, 2**63, size=n, dtype=np.uint64))
            s = minhash.superminhash([a, a[: int(n * 0.8)]], 200)
            shares.append((s[0] == s[1]).mean())
        assert abs(np.mean(shares) - 0.8) < 0.02 and np.std(shares) < (0.16 / 200) ** 0.5 * 1.2


def near_components(texts, size, percent=80):
    sets = {i: minhash.shingle_set(t or "", size) for i, t in texts}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations([i for i in sets if sets[i]], 2):
        common = len(sets[a] & sets[b])
        if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_of_a_large_group_and_small_ones(docs, size):
    r = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for base in range(12):
        text = [r.choice(words) for _ in range(120)]
        for _ in range(60 if base == 0 else r.randint(1, 4)):
            copy = list(text)
            for _ in range(r.randint(0, 12 // size)):
                copy[r.randrange(len(copy))] = r.choice(words)
            texts.append((len(texts), " ".join(copy)))
    texts += [(900, None), (901, ""), (902, "A b"), (903, "a B"), (904, "lone")]
    got = rows(minhash.near_duplicates(docs(*texts), size))
    assert {i: (g["n_shingles"], g["component_id"]) for i, g in got.items()} == near_components(texts, size)
    assert all(g["kept"] == (i == g["component_id"]) for i, g in got.items())


def test_versions_too_far_from_their_text_are_not_compared_in_pairs(docs, monkeypatch):
    """Some near enough to the text, most of them not, two of these near each other: few comparisons, no link lost."""
    r = random.Random(8)
    text = [f"w{i}" for i in range(200)]

    def version(of, edits):
        out = list(of)
        for at in r.sample(range(len(out)), edits):
            out[at] = f"x{r.random()}"
        return out

    copies = [text] + [version(text, 8) for _ in range(20)] + [version(text, 14) for _ in range(60)]
    copies.append(version(copies[-1], 4))
    texts = [(i, " ".join(c)) for i, c in enumerate(copies)]
    compared, confirmed = [], minhash.confirmed

    def counted(pairs, *args):
        compared.append(pairs.count())
        return confirmed(pairs, *args)

    monkeypatch.setattr(minhash, "confirmed", counted)
    got = rows(minhash.near_duplicates(docs(*texts), 2))
    assert {i: (g["n_shingles"], g["component_id"]) for i, g in got.items()} == near_components(texts, 2)
    assert sum(compared) < 6 * len(texts)


def test_forget_lets_shuffle_files_of_the_last_frame_go(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))

    for _ in range(3):
        forget(spark)
    time.sleep(1)
    before = shuffled()
    stored = settle(spark.range(1000).repartition(7, "id"), "forgotten")
    forget(spark)
    time.sleep(1)
    assert shuffled() <= before and stored.count() == 1000


def test_hub_rounds_lose_no_connection(spark):
    """A path of links inside one bucket, where no hub is linked to all."""
    members = spark.createDataFrame([(1, i) for i in range(30)] + [(2, i) for i in range(0, 30, 2)], "band long, doc long")
    sizes = spark.createDataFrame([(i, 1) for i in range(30)], "doc long, n long")
    _, groups = grouping.linked_groups(members, sizes, "n = n_b", lambda p: p.where("abs(a - b) = 1"))
    assert {r.component for r in groups.collect()} == {0} and groups.count() == 30


# repeated passages


def test_automaton_matches_and_repeats():
    assert substring.SuffixAutomaton().feed(list("abcabcab")) == [0, 0, 0, 1, 2, 3, 4, 5]
    r = random.Random(7)
    for _ in range(40):
        automaton, past = substring.SuffixAutomaton(), []
        for _ in range(4):
            word = [r.choice("ab") for _ in range(r.randint(1, 15))]
            expected = []
            for end in range(1, len(word) + 1):
                known = "|".join(past) + "|"
                own = "".join(word[: end - 1])
                k = next(k for k in range(end, -1, -1) if "".join(word[end - k : end]) in known or "".join(word[end - k : end]) in own)
                expected.append(k)
            assert automaton.feed(word) == expected
            past.append("".join(word))


@pytest.mark.parametrize("often", [2000, 2])
def test_repeated_windows_go(docs, often):
    r = random.Random(8)
    shared = [sentence(r, [f"s{i}" for i in range(50)], n) for n in (25, 40, 70)]
    texts = []
    for i in range(60):
        parts = [sentence(r, [f"v{i}" for i in range(30)], r.randint(1, 30)) for _ in range(3)]
        parts.insert(r.randint(0, 3), r.choice(shared))
        texts.append((i, "\n".join(parts)))
    texts += [(70, "ab " * 100), (71, "x y z " * 30), (72, texts[3][1]), (73, None), (74, "")]
    seen, expected = set(), {}
    for i, t in texts:
        ws = WORD.findall(t or "")
        hit = [False] * len(ws)
        for k in range(len(ws) - 19):
            key = tuple(ws[k : k + 20])
            if key in seen:
                hit[k : k + 20] = [True] * 20
            seen.add(key)
        kept = " ".join(w for w, h in zip(ws, hit, strict=True) if not h)
        expected[i] = (len(ws), sum(hit), hashlib.sha256(kept.encode()).hexdigest())
    got = rows(substring.remove_repeats(docs(*texts).repartition(5), often=often))
    assert {i: (g["n_words"], g["n_removed"], g["kept_sha256"]) for i, g in got.items()} == expected


# personal data


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        worth = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(w - 9 if w > 9 else w for w in worth) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def test_base_spans(docs):
    r = random.Random(9)
    parts = ["a@b.cc", "x+y@d-e.f.g", "@", "a.b@c", "10.0.0.1", "999.1.1.1", "1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 1234-567", "+1", " ", "é", "𝄞", "word", "7", "\n", ".", "+c@d.ee"]
    texts = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 25)))) for i in range(200)]
    texts += [(300, "1" * 5000), (301, "a@b.cc " * 500), (302, None), (303, "1-2 " * 3000)]
    got = rows(pii.personal_spans(docs(*texts)))
    for i, t in texts:
        spans = sorted((m.start(), k, m.end()) for k, kind in enumerate(BASE) for m in re.finditer(BASE[kind], t or "") if valid(kind, m.group()))
        text = ",".join(f"{list(BASE)[k]}:{a}:{b}" for a, k, b in spans)
        assert [s for s in got[i]["spans"].split(",") if s.split(":")[0] in BASE] == [s for s in text.split(",") if s]
        assert got[i]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in BASE] == [sum(k == n for _, n, _ in spans) for k in range(4)]


def test_terms_that_only_stand_by_an_entity_go(docs):
    near = [(i, f"Call Zaphod about the ship, mail z@galaxy.org, the ship waits {i}") for i in range(4)]
    far = [(10 + i, f"the ship waits about the mail call {i}") for i in range(40)]
    got = rows(pii.personal_spans(docs(*near, *far)))
    assert got[0]["spans"] == "removed:5:11,email:33:45".replace("33:45", f"{near[0][1].index('z@')}:{near[0][1].index('z@') + 12}")
    assert got[12]["spans"] == ""
    clean = rows(pii.sanitise(docs(*near, *far)))
    assert clean[0]["text"] == "Call  about the ship, mail [email], the ship waits 0" and clean[12]["text"] == far[2][1]


def test_terms_count_over_whole_documents(docs):
    """Far from the entity, in a document once more, and counted with documents that hold the term alone."""
    fill = "the ship waits about the mail call " * 20
    near = [(i, f"Zaphod {fill} z@galaxy.org {fill} zaphod Trillian {i} x{i}@one.org") for i in range(3)]
    texts = [*near, near[2], (5, f"Trillian {fill}"), (6, f"z@galaxy.org {fill}"), (None, near[0][1]), *((10 + i, f"{fill} {i}") for i in range(40))]
    cut = lambda t: set(re.findall(r"\w+", t.lower()))
    n, entities = len(texts), {}
    for row, (_, t) in enumerate(texts):
        for e in set(re.findall(r"[\w.]+@[\w.]+", t)):
            entities.setdefault(e, set()).add(row)
    got = {}
    for x in pii.personal_spans(docs(*texts)).collect():
        got.setdefault(x.doc_id, []).append(x.spans)
    for row, (i, t) in enumerate(texts):
        base = [m.span() for m in re.finditer(r"[\w.]+@[\w.]+", t)]
        spans = [(a, "email", b) for a, b in base]
        for m in re.finditer(r"\w+", t):
            term, kinds = m.group().lower(), []
            with_term = sum(term in cut(o) for _, o in texts)
            for e, at in entities.items():
                both = sum(term in cut(texts[o][1]) for o in at)
                if row in at and both >= 2:
                    kinds.append(np.log(n * both / (with_term * len(at))) / np.log(n / len(at)))
            if max(kinds, default=0) >= 0.8 and not any(a < m.end() and b > m.start() for a, b in base):
                spans.append((m.start(), "removed" if max(kinds) >= 0.95 - 1e-12 else "generalised", m.end()))
        assert got[i] == [",".join(f"{k}:{a}:{b}" for a, k, b in sorted(spans))] * sum(i == o for o, _ in texts), i
    assert got[0][0].startswith("removed:0:6,") and got[0][0].count("removed") >= 2 and got[5] == [""]


# token files


def test_separators_are_stitched_over_blocks(spark, tmp_path):
    r, ids, expected = np.random.default_rng(10), [], []
    for _ in range(60):
        n = int(r.integers(0, 12))
        expected.append((len(ids), n, True))
        ids += r.integers(1, 9, size=n).tolist() + [9]
    expected.append((len(ids), 3, False))
    (tmp_path / "a.bin").write_bytes(np.asarray([*ids, 1, 2, 3], dtype="<u2").tobytes())
    (tmp_path / "b.bin").write_bytes(b"")
    blocks = token_scan.read_token_files(spark, str(tmp_path), block_ids=7)
    found = token_scan.document_tokens(blocks, end_id=9, block_ids=7).orderBy("ordinal").collect()
    assert [(x.start, x.n_tokens, x.ended) for x in found] == expected and [x.ordinal for x in found] == list(range(61))


def test_a_file_is_read_by_many_tasks_and_the_query_reads_files(spark, docs, tmp_path):
    ids = np.random.default_rng(15).integers(0, 9, size=1001).astype("<u2")
    (tmp_path / "a b.bin").write_bytes(ids.tobytes() + b"x")
    blocks = token_scan.read_token_files(spark, str(tmp_path), block_ids=10, range_blocks=3)
    got = blocks.withColumn("task", F.spark_partition_id()).orderBy("block").collect()
    assert b"".join(x.ids for x in got) == ids.tobytes() and [x.block for x in got] == list(range(101))
    assert len({x.task for x in got}) == 34 and len({(x.task, x.block // 3) for x in got}) == 34
    source = str(tmp_path / "docs")
    texts = [(i, "lake stone " * (i % 50)) for i in range(200)] + [(900, None), (901, "<|endoftext|> in text"), (None, "lake")]
    docs(*texts).repartition(3).write.parquet(source)
    found = rows(token_scan.token_file_scan(spark.read.parquet(source)))
    tokenizer = WordTokenizer(tokenizer_path()).tokenizer
    tokenizer.encode_special_tokens = True
    assert {i: g["n_tokens"] for i, g in found.items()} == {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in texts}
    assert all(g["ended"] and g["file"].startswith("file:") for g in found.values())


def test_documents_of_a_derived_frame_keep_their_ids(spark, docs):
    """Two jobs over a shuffle may see other partitions; the ids must stay with the texts."""
    texts = [(i, "lake stone " * (i % 50)) for i in range(600)]
    derived = docs(*texts).repartition(7).groupBy("doc_id").agg(F.max("text").alias("text")).where("length(text) >= 0")
    found = token_scan.token_file_scan(derived).collect()
    tokenizer = WordTokenizer(tokenizer_path()).tokenizer
    assert {x.doc_id: x.n_tokens for x in found} == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) for i, t in texts}
    assert len(found) == len(texts)


def test_token_files_of_odd_rows(docs):
    tokenizer = WordTokenizer(tokenizer_path()).tokenizer
    expected = sorted((i is None, i or 0, len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in ODD)
    assert sorted((x.doc_id is None, x.doc_id or 0, x.n_tokens) for x in token_scan.token_file_scan(docs(*ODD)).collect()) == expected


def test_streams_count_every_document(docs):
    texts = [(i, "lake stone " * (i % 50)) for i in range(200)] + [(900, None), (901, "<|endoftext|> in text")]
    stream = token_scan.token_stream(docs(*texts).repartition(3), block_ids=64)
    found = rows(token_scan.document_tokens(stream, block_ids=64))
    tokenizer = WordTokenizer(tokenizer_path()).tokenizer
    tokenizer.encode_special_tokens = True
    assert {i: g["n_tokens"] for i, g in found.items()} == {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in texts}


@pytest.mark.parametrize("n", [1, 2, 5, 1000, 4097])
def test_permutation_and_its_inverse(n):
    slots = training_order.permuted(np.arange(n), n, key=3)
    assert sorted(slots.tolist()) == list(range(n))
    assert training_order.permuted(slots, n, key=3, inverse=True).tolist() == list(range(n))
    assert n < 1000 or not np.array_equal(slots, training_order.permuted(np.arange(n), n, key=4))


def test_shards_hold_all_tokens(spark, docs, tmp_path):
    texts = [(i, "lake stone " * (i % 50)) for i in range(200)] + [(900, None)]
    path, source = str(tmp_path / "shards"), str(tmp_path / "docs")
    docs(*texts).repartition(3).write.parquet(source)
    stored = spark.read.parquet(source)
    n = training_order.write_training_order(stored, path, size=63, slots_per_shard=20)
    held = training_order.read_training_order(spark, path).toPandas().sort_values("slot")
    assert held["slot"].tolist() == list(range(n)) and sorted(held["sequence_id"]) == list(range(n))
    assert held["sequence_id"].tolist() == training_order.permuted(np.arange(n), n, inverse=True).tolist()
    sizes = sorted(f.stat().st_size for f in (tmp_path / "shards").rglob("part-*") if f.stat().st_size)
    assert sizes[-1] == 20 * 128 and sum(sizes) == n * 128
    # each record holds the ids of its sequence: the partitions' streams, cut
    tokenizer = WordTokenizer(tokenizer_path()).tokenizer
    streams = {}
    for x in stored.select(F.spark_partition_id().alias("part"), "text").collect():
        streams.setdefault(x.part, []).extend([*tokenizer.encode(x.text or "", add_special_tokens=False).ids, training_order.END_OF_TEXT])
    cut = [s[at : at + 63] for _, s in sorted(streams.items()) for at in range(0, len(s), 63)]
    assert len(cut) == n
    for x in held.itertuples():
        ids = np.asarray(cut[x.sequence_id], "<u2").tobytes()
        assert (x.ids, x.n_tokens, x.ids_crc32) == (ids, len(ids) // 2, zlib.crc32(ids))
        assert (x.shard, x.row) == divmod(x.slot, 20)
    # a reader starts and stops at any slot
    for start, stop in [(0, 1), (19, 21), (25, None), (n - 1, n + 5), (n, None), (-3, 20)]:
        got = training_order.read_training_order(spark, path, start, stop).toPandas().sort_values("slot")
        want = held[(held["slot"] >= start) & (held["slot"] < (n if stop is None else stop))]
        assert got.values.tolist() == want.values.tolist()


def test_an_unfinished_order_is_not_read(spark, docs, tmp_path):
    path = str(tmp_path / "shards")
    training_order.write_training_order(docs((1, "lake"), (2, "stone")), path, size=3, slots_per_shard=1)
    (tmp_path / "shards" / training_order.HEADER).unlink()
    with pytest.raises(Exception, match="header"):
        training_order.read_training_order(spark, path)


# benchmark


@pytest.mark.parametrize("block_bytes", [4_000_000, 50])
def test_contamination(spark, docs, block_bytes):
    r = random.Random(11)
    words = [f"w{i}" for i in range(12)]
    items = [(i, sentence(r, words, r.choice([3, 9, 10, 14, 40]))) for i in range(12)] + [(50, None), (51, "!!"), (52, "W1, w2. w3")]
    texts = [(i, sentence(r, words, 60)) for i in range(40)] + [(70, f"x {items[3][1].upper()} y"), (71, None), (72, items[4][1] + " " + items[4][1])]
    cut = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").lower())
    windows = {}
    for i, t in items:
        ws = cut(t)
        size = min(10, len(ws))
        for k in range(len(ws) - size + 1 if ws else 0):
            windows.setdefault(tuple(ws[k : k + size]), set()).add(str(i))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = rows(decontaminate.contamination(docs(*texts), bench, block_bytes=block_bytes))
    for i, t in texts:
        ws, hit, names = cut(t), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(ws) - size + 1):
                if found := windows.get(tuple(ws[k : k + size])):
                    names |= found
                    hit |= set(range(k, k + size))
        sha = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["n_items"], got[i]["items_sha256"], got[i]["contaminated"]) == (len(ws), len(hit), len(names), sha, bool(hit))
    left = decontaminate.decontaminate(docs(*texts), bench)
    assert left.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" boolean", "").split(", ")
    assert {x.doc_id for x in left.collect()} == {i for i, g in got.items() if not g["contaminated"]}


# toxicity


def test_the_network_is_fitted_in_a_task(spark, docs, monkeypatch):
    """No table comes to the driver, and without rows the score is 0."""
    sample = docs(*[(i, f"good day {i}") for i in range(30)], *[(i, f"foul day {i}") for i in range(30, 60)])
    sample = sample.withColumn("toxic", (F.col("doc_id") >= 30).cast("int"))
    here = toxicity.train(sample.orderBy("doc_id").toPandas())
    monkeypatch.setattr(type(sample), "toPandas", None)
    there = toxicity.fitted(sample)
    assert all(np.array_equal(here.p[k], there.p[k]) for k in here.p)
    assert toxicity.fitted(sample.limit(0)) == 0.0
    labels = sample.select("doc_id", "toxic")
    assert toxicity.toxicity(sample, labels).count() == 60


def test_gradients():
    lists = [[b"good", b"day"], [b"bad", b"bad", b"night", b"bad"], [b"so"]]
    net = toxicity.Network(1)
    r = np.random.default_rng(1)
    net.p = {k: (v if v.any() else r.standard_normal(v.shape) * 0.3).astype(np.float64) for k, v in net.p.items()}
    trainer = toxicity.Trainer(net, lists)
    label, chosen = np.asarray([0.0, 1.0, 1.0]), np.arange(3)

    def loss():
        logit = net.forward(net.gates(trainer.features), trainer.index(chosen))
        return float(np.mean(np.logaddexp(0, logit) - label * logit))

    before = {k: v.copy() for k, v in net.p.items()}
    trainer.rate = 0.0
    seen = {}
    trainer.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    trainer.step(chosen, label)
    seen = {k: m / 0.1 for k, (m, _) in trainer.moments.items()}
    for k in ("word", "char", "input", "state", "attend", "query", "out", "gate_bias", "attend_bias", "bias"):
        at = np.unravel_index(np.argmax(np.abs(seen[k])), seen[k].shape)
        net.p[k][at] = before[k][at] + 1e-4
        high = loss()
        net.p[k][at] = before[k][at] - 1e-4
        low = loss()
        net.p[k][at] = before[k][at]
        assert abs((high - low) / 2e-4 - seen[k][at]) < 1e-3 * max(1, abs(seen[k][at])), k


def test_windows_overlap_and_cover():
    bounds = np.asarray([0, 0, 1, 65, 400])
    first, length, doc = toxicity.windows(bounds)
    for d in range(4):
        own = sorted(zip(first[doc == d].tolist(), length[doc == d].tolist(), strict=True))
        assert set().union(*(range(f, f + n) for f, n in own)) == set(range(bounds[d], bounds[d + 1]))
        assert all(a[0] + a[1] > b[0] for a, b in itertools.pairwise(own))


def test_held_out_texts_are_told_apart(docs, spark):
    r = random.Random(12)
    texts, labels = [], []
    for i in range(400):
        ws = [f"{r.choice('bdfgkl')}{r.choice('aeiou')}{r.choice('mnrst')}" for _ in range(r.randint(5, 120))]
        toxic = i % 4 == 0
        if toxic:
            ws[r.randrange(len(ws))] = r.choice(["vixqu", "vixquon", "zazvix"])
        texts.append((i, " ".join(ws)))
        labels.append((i, int(toxic)))
    got = toxicity.toxicity(docs(*texts, (900, None), (901, "")), spark.createDataFrame(labels, "doc_id long, toxic int")).toPandas()
    held = got[got["held_out"] & (got["doc_id"] < 900)]
    truth = held["doc_id"].map(dict(labels))
    assert (held["predicted"] == truth).mean() > 0.9
    assert got["held_out"].tolist() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]
    assert got.loc[got["doc_id"] >= 900, "score"].tolist() == [0.0, 0.0] and got["score"].between(0, 1).all()


# the pipeline


def test_every_stage_of_the_pipeline_against_brute_force(docs, spark, tmp_path, monkeypatch):
    r = random.Random(16)
    word = lambda: f"{r.choice('bdfgkl')}{r.choice('aeiou')}{r.choice('mnrst')}{r.choice('aeiou')}{r.choice('bdklp')}"
    plain = lambda n: " ".join(word() for _ in range(n))
    items = [(1, plain(14)), (2, "Short item"), (3, None)]
    texts, labels = [], []
    for i in range(240):
        t = plain(r.randint(20, 60)) + "\nYes.\n\n" + plain(r.randint(20, 60))
        if i % 4 == 0:
            t += " " + r.choice(["vixqu", "vixquon", "zazvix"])
        texts.append((i, t))
        labels.append((i, int(i % 4 == 0)))
    clean = [t for i, t in texts if i % 4]
    long = plain(120)
    texts += [(300, clean[0]), (301, clean[1].replace("Yes.", "No.")), (302, clean[2].split("\n")[0] + "\n" + clean[3].split("\n")[0])]
    texts += [(310, long), (311, f"{long[:300]}\n{long[301:]}"), (320, f"{plain(9)} {items[0][1]} {plain(9)}"), (321, f"{plain(9)} short ITEM!")]
    texts += [(330, None), (331, ""), (332, " \n"), (333, clean[5]), (333, clean[5]), (None, clean[0]), (None, None)]
    docs(*texts).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    seen = []

    def watched(stage):
        def run(spark, given, sf_dir):
            assert given.columns == docs().columns
            seen.append([(x.doc_id, x.text) for x in given.collect()])
            return stage(spark, given, sf_dir)

        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(name, watched(stage)) for name, stage in corpus_pipeline.STAGES])
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    first, lines, near, contaminated, last = seen
    bag = lambda rows: sorted(rows, key=repr)

    assert bag(first) == bag(texts) and set(lines) <= set(texts)
    gone = {i for i, _ in texts} - {i for i, _ in lines}
    assert len(gone ^ {i for i, t in texts if "vix" in (t or "")}) <= 12 and sum(i is None for i, _ in lines) == 2

    # lines: linked ones are a class; the first one stays, rows without an id lose none
    rows_ = [(d is None, d or 0, n, line) for d, t in lines for n, line in enumerate((t or "").split("\n")) if line.strip()]
    distinct = sorted({x[3] for x in rows_})
    group = {x: x for x in distinct}
    long_ = [x for x in distinct if len(x) >= 16]
    pairs = list(itertools.combinations(long_, 2))
    for (a, b), link in zip(pairs, line_dedup.alike([a for a, _ in pairs], [b for _, b in pairs], None).tolist(), strict=True):
        if link:
            group = {x: group[a] if g == group[b] else g for x, g in group.items()}
    head, sets = {}, {}
    for *at, line in sorted(rows_):
        head.setdefault(group[line], at)
        if not at[0]:
            sets.setdefault(at[1], set()).add(group[line])
    expected = []
    for d, t in lines:
        if d is None or t is None:
            expected.append((d, t))
            continue
        left = "\n".join(x for n, x in enumerate(t.split("\n")) if not x.strip() or head[group[x]] == [False, d, n])
        if left.strip() or not t.strip():
            expected.append((d, left))
        elif not any(o < d and sets[d] <= s for o, s in sets.items()):
            expected.append((d, t))
    assert bag(near) == bag(expected) and {300, 302, 333, 330, 331, 332} & {d for d, _ in near} == {302, 333, 330, 331, 332} & {d for d, _ in lines} - {333}

    parts = near_components([(d, t) for d, t in near if d is not None], 5)
    assert bag(contaminated) == bag((d, t) for d, t in near if d is None or parts[d][1] == d)
    cut = lambda t: " ".join(["", *re.findall(r"[a-z0-9]+", (t or "").lower()), ""])
    keys = [f" {' '.join(w[k : k + 10])} " for _, t in items if (w := cut(t).split()) for k in range(max(1, len(w) - 9))]
    assert bag(last) == bag((d, t) for d, t in contaminated if not any(k in cut(t) for k in keys))
    assert not {320, 321} & {d for d, _ in last} and {x["doc_id"] for x in packed} >= {d for d, t in last if t and d is not None}
