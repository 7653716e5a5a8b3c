"""Each operator on a small table with every odd case, against a plain version."""

import random
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from litloom.llm import hnsw, jaccard, lm, mix, pack, quality, resample, runtime, shard, substring, suffix, windows
from litloom.llm.components import components

random.seed(4)
WORDS = [f"w{i}" for i in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n)) + "."


PASSAGE = prose(60, 1)
TEXTS = [
    prose(120, 2), prose(90, 3) + " " + PASSAGE + " " + prose(70, 5), prose(30, 6) + " " + PASSAGE, prose(120, 2), prose(120, 2) + " more words here", None, "", "   \n\t ", "one two three",
    "One TWO three", "a " * 300, "éàü ñ 漢字 " * 40, prose(3000, 7), prose(49, 8), "x", prose(120, 2).replace("w1 ", "changed ", 2), "Menu | Home | About | Contact us\n" + prose(60, 9), "BUY NOW!! BUY NOW!! " * 30,
    "same line ends here.\n" * 5 + prose(80, 10),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid string, did string, size string, shard string, kept string, n_words string, spans string, label string"


def frame(spark, rows):
    """Rows of (doc_id, text, source), with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), "a", "b", "c", "d", "e", "f", "g", "h") for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, [(i, t, ["a", "b", None, "é"][i % 4]) for i, t in enumerate(TEXTS)])


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, repeated rows, null sources."""
    return frame(spark, [(None, TEXTS[0], None), (None, None, None), (1, TEXTS[1], "a"), (1, TEXTS[1], "a"), (1, TEXTS[2], "b"), (2, "", None)])


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


ROWS = list(enumerate(TEXTS))
LABELS = "doc_id long, quality int, toxic int"


def all_ops(spark, docs):
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(19)] + [(None, 1, 0), (3, None, None)], LABELS)
    return {
        "op1": substring.substring_digest(docs), "op2": quality.quality_digest(docs), "op3": pack.pack_digest(docs), "op4": shard.shard_digest(docs), "op5": resample.resample_digest(docs, labels),
        "op6": jaccard.jaccard_digest(docs), "op8": suffix.suffix_digest(docs), "op9": lm.score_documents(docs), "op10": mix.mix_digest(docs),
    }


def test_empty_table_gives_no_rows(spark, empty):
    for name, df in all_ops(spark, empty).items():
        assert df.count() == 0, name


def test_null_ids_and_repeated_rows_are_rows_of_their_own(spark, odd):
    for name, df in all_ops(spark, odd).items():
        if name != "op3":
            assert sorted(str(r.doc_id) for r in df.collect()) == ["1", "1", "1", "2", "None", "None"], name


def test_substring_dedup(docs):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.substring_digest(docs).collect()}
    assert got == dict(enumerate(substring.brute_force(TEXTS)))


def test_substring_dedup_deals_out_crowded_minimisers(docs):
    kind = windows.Kind(True, 35, 8)
    _, spans = windows.repeated_spans(docs, kind, substring.counter(35), False, hot=1)
    got = {r.did: int(windows.covered(len((TEXTS[r.did] or "").split()), [s.asDict() for s in r.spans], 35).sum()) for r in spans.collect()}
    assert got == {i: n for i, (_, n, _) in enumerate(substring.brute_force(TEXTS)) if n}


def test_suffix_dedup(docs):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.suffix_digest(docs).collect()}
    assert got == suffix.brute_force(ROWS)


def test_suffix_dedup_deals_out_crowded_minimisers(docs):
    _, spans = windows.repeated_spans(docs, windows.Kind(False, 100, 32), suffix.factor_reaches(100), True, hot=1)
    got = {r.did: int(windows.covered(len(TEXTS[r.did].encode()), [s.asDict() for s in r.spans], 100).sum()) for r in spans.collect()}
    assert got == {i: n for i, (_, n, _, _) in suffix.brute_force(ROWS).items() if n}


LINE = " ".join(f"c{i}" for i in range(12))


def crowded():
    """Copies of texts, a line and a passage that most texts share, and short texts with copies."""
    rows = [(i, f"{prose(50, 100 + i)} {LINE} {prose(40, 300 + i)}" + (f" {PASSAGE}" if i % 3 else "")) for i in range(120)]
    rows += [(200 + i, rows[4][1]) for i in range(60)] + [(300 + i, f"{PASSAGE} x{i}") for i in range(60)]
    return rows + [(400 + i, "short text") for i in range(9)] + [(500, prose(35, 60)), (501, prose(35, 60)), (502, "é" * 50), (503, "é" * 50), (504, None)]


@pytest.mark.parametrize("hot", [1, windows.HOT])
def test_crowds_of_texts_lines_and_passages(spark, hot):
    rows = crowded()
    docs = frame(spark, [(i, t, "a") for i, t in rows])
    for kind, verdict, spare in ((windows.Kind(True, 35, 8), substring.counter(35), False), (windows.Kind(False, 100, 32), suffix.factor_reaches(100), True)):
        _, spans = windows.repeated_spans(docs, kind, verdict, spare, hot=hot)
        length = (lambda t: len(t.split())) if kind.words else (lambda t: len(t.encode()))
        texts = dict(rows)
        got = {r.did: int(windows.covered(length(texts[r.did]), [s.asDict() for s in r.spans], kind.window).sum()) for r in spans.collect()}
        truth = {i: n for (i, _), (_, n, _) in zip(rows, substring.brute_force([t for _, t in rows]), strict=True)} if kind.words else {i: x[1] for i, x in suffix.brute_force(rows).items()}
        assert {i: n for i, n in got.items() if n} == {i: n for i, n in truth.items() if n}


def test_segments_do_not_depend_on_chunks(monkeypatch):
    data = " ".join(t for t in TEXTS if t).encode()
    units, firsts = windows.word_units(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    kind = windows.Kind(True, 35, 8)


    def grams():
        return sorted(g for _, _, n, gram, _ in windows.segments(units, firsts, kind, True) for g, k in zip(gram.tolist(), n.tolist(), strict=True) for _ in range(k))

    whole = grams()
    monkeypatch.setattr(windows, "CHUNK", 100)
    assert grams() == whole


def plain_quality(text):
    words = [w.decode() for w in (text or "").encode().split()]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    base_failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated), base_failed


def test_quality_rules(docs):
    rows = {r.doc_id: r for r in quality.quality_digest(docs).collect()}
    for i, text in ROWS:
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_quality(text), i
        assert not (r.base_failed and r.kept)
    assert rows[0].kept and rows[1].kept and rows[12].kept and not rows[17].kept and not rows[10].kept


def plain_verdict(text):
    """(kept, clean text) by the line rules, in plain Python."""
    import re

    if text is None:
        return False, None
    good, left, whole = [], 0, len(text.encode().split())
    for line in text.split("\n"):
        words = [w.decode() for w in line.encode().split()]
        if not words:
            continue
        letters = [c for c in line if c.isalpha()]
        last = re.sub(r"[\"'”’»)\]]*$", "", line[-quality.TAIL :].rstrip(" \t\r\f\v"))[-1:]
        bad = last not in tuple(".!?…:;,。！？") and len(words) > 4
        items = re.findall(r"(?=\s[|»›·•>]\s)", line)
        bad |= len(items) >= 2 or bool(re.match(r"\s*[|»›·•>]\s", line) and re.match(r"^\s*(?:[|»›·•>]\s)", line))
        bad |= any(re.search(r"\b" + p, line.lower()) for p in quality.PHRASES)
        bad |= len(letters) >= 20 and line == line.upper() != line.lower()
        bad |= 4 * sum(line.count(c) for c in quality.SYMBOLS) >= len(words)
        bad |= len(words) >= 10 and 2 * sum(a == b for a, b in zip(words, words[1:], strict=False)) >= len(words)
        if not bad:
            good.append(line)
            left += len(words)
    return not plain_quality(text)[-1] and left >= quality.KEEP_SHARE * whole, "\n".join(good)


def test_quality_verdicts(spark):
    lines = [prose(12, 50) + x for x in ("", "”)", " »", "!?")] + ["Menu | Home | About | Contact", "| x y z", "All Rights RESERVED.", "Tous droits réservés, 2020.", "Impressum und Hinweise.", "Alle Rechte vorbehalten.", "Política de Privacidad.", "Klick auf Impressumsseite hier bitte.",
             "COPYRIGHT © 2020.", "we shout", "WE SHOUT ABOUT THINGS IN LETTERS.", "ÜBER ÄRGER UND ÖFEN REDEN WIR HIER.", "# $ % words with symbols.", "one two three four five six seven", "Short heading", "so so so so so so so so so so so.", "", "  ", "漢字 漢字。", "10 20 30 40 50 60 70."]
    r = random.Random(9)
    texts = ["\n".join(r.choice(lines) if r.random() < share else prose(r.randrange(4, 30), 900 + 31 * k + j) for j in range(r.randrange(1, 9))) for k, share in enumerate([0.1, 0.3, 0.6, 0.9] * 30)]
    rows = [*ROWS, *enumerate(texts, 100), *((300 + i, x) for i, x in enumerate(lines))]
    kept = 0
    for x in quality.clean_documents(frame(spark, [(i, t, "a") for i, t in rows])).collect():
        assert (x.kept, x.clean_text) == plain_verdict(dict(rows)[x.doc_id]), dict(rows)[x.doc_id]
        kept += x.kept
    assert 10 < kept < len(rows) - 10


def test_quality_rules_drop_bad_lines(docs):
    rows = {r.doc_id: r for r in quality.clean_documents(docs).collect()}
    assert "Menu" not in rows[16].clean_text and rows[16].n_navigation_lines == 1 and rows[5].clean_text is None and rows[6].clean_text == ""


def test_packing_round_trip(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(pack.default_tokenizer())
    pieces = {}
    for r in pack.packed_pieces(docs).collect():
        pieces.setdefault(r.doc_id, []).append(r)
        assert r.length <= 1024 and r.length & (r.length - 1) == 0 and r.offset == 0
    assert len({r.sequence_id for p in pieces.values() for r in p}) == sum(map(len, pieces.values()))
    for i, text in ROWS:
        mine = sorted(pieces[i], key=lambda r: r.start)
        ids = np.frombuffer(b"".join(bytes(r.ids) for r in mine), "<u4").tolist()
        assert ids == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert [r.start for r in mine] == np.cumsum([0, *(r.length for r in mine)])[:-1].tolist() and mine[0].doc_tokens == len(ids)
    digest = {(r.doc_id, r.start): r.ids_crc32 for r in pack.pack_digest(docs).collect()}
    assert all(digest[i, r.start] == zlib.crc32(bytes(r.ids)) for i, p in pieces.items() for r in p)


def test_encoder_agrees_on_odd_texts():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(pack.default_tokenizer())
    encode = pack.text_encoder(pack.default_tokenizer())
    end = "<|endoftext|>"
    for text in [end, f"{end}a", f"a {end} b", f"a{end}", f"a {end}{end} {end}", f"{end[:-1]}{end}", f"x  {end}\n\n y {end[1:]}", prose(30_000, 5) + end + " " + prose(90_000, 6) + f" {end}", "", " ", "  a  b", "a\n b", "it's  \n\n x", "a  b", "<|endoftext|> x", "é è　c", "don 't", "x" * 3000, prose(40_000, 3), "\x1c a \x85b"]:
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 1_000_000, "\n" * 900_000 + "x", "a" + " \n\t" * 400_000 + "b c " * 60_000, "word " * 50_000 + "\u00a0" * 800_000])
def test_encoder_gets_through_long_white_space(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(pack.default_tokenizer())
    assert np.frombuffer(pack.text_encoder(pack.default_tokenizer())(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_that_take_in_spaces(tmp_path):
    import json

    from tokenizers import Tokenizer

    with open(pack.default_tokenizer(), encoding="utf-8") as f:
        spec = json.load(f)
    own = spec["added_tokens"][0]
    for more in ([], [own | {"id": 50257, "content": "<|end"}], [own | {"id": 50257, "content": "<pad>", "lstrip": True}]):
        path = tmp_path / f"{len(list(tmp_path.iterdir()))}.json"
        path.write_text(json.dumps(spec | {"added_tokens": [own, *more] if more else []}))
        encode, tokenizer = pack.text_encoder(str(path)), Tokenizer.from_file(str(path))
        for text in ("a <|endoftext|> b <|end c  <pad> d", "<pad>", ""):
            assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_sequences_are_written_by_bucket(spark, docs, tmp_path):
    pack.write_sequences(docs, str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert all(len(r.ids) == 4 * r.length for r in rows) and len(rows) == pack.packed_pieces(docs).count()


def test_lengths():
    assert pack.lengths(3000) == [1024, 1024, 512, 256, 128, 32, 16, 8] and pack.lengths(1) == [1] and sum(pack.lengths(99_999)) == 99_999


def plain_shards(rows, n=24):
    sizes = [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in sorted(rows)]
    total, at, out, slots = sum(s for _, s, _ in sizes), 0, {}, {}
    for i, size, crc in sizes:
        s = min(n - 1, at * n // total)
        out[i] = (size, crc, "bytes", s, slots.get(s, 0), None)
        slots[s] = slots.get(s, 0) + 1
        at += size
    return out


def test_sharding(docs):
    assert {r.doc_id: tuple(r)[1:] for r in shard.shard_digest(docs).collect()} == plain_shards(ROWS)


def test_shards_written_hold_what_they_are_assigned(spark, docs, tmp_path):
    assigned = shard.write_shards(docs, str(tmp_path / "out"))
    written = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.doc_id, r.shard) for r in written.collect()) == sorted((r.doc_id, r.shard) for r in assigned.collect())


def test_jaccard_join(docs):
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_digest(docs).collect()} == jaccard.brute_force(ROWS)


def near_copies():
    """A crowd of copies with many small changes, so that not all link with one hub."""
    base, rows = prose(150, 21).split(), []
    for i in range(40):
        r, words = random.Random(i), list(base)
        for _ in range(1 + i % 5):
            words[r.randrange(len(words))] = f"n{r.random()}"
        rows.append((i, " ".join(words)))
    return rows + [(100 + i, prose(n, 30 + i)) for i, n in enumerate((1, 2, 4, 5, 6, 7, 9, 12, 20, 33))] + [(200 + i, " ".join(prose(n, 30 + i).split()[:-1]) + " z") for i, n in enumerate((1, 2, 4, 5, 6, 7, 9, 12, 20, 33))]


@pytest.mark.parametrize("block", [3, 4096])
def test_jaccard_join_of_a_crowd(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "HUB_MEMBERS", 64)
    rows = near_copies()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_digest(frame(spark, [(i, t, "a") for i, t in rows])).collect()}
    assert got == jaccard.brute_force(rows)


def test_one_of_each_keeps_unlike_texts_whose_ids_are_null_or_repeated(spark):
    like = [" ".join(f"w{k}" for k in range(100)), " ".join(["x", *(f"w{k}" for k in range(1, 100))])]
    rows = [(None, "a b c d e f g", "a"), (None, "h i j k l m n", "a"), (None, "h i j k l m n", "a"), (0, "o p q r s t u", "a"), (5, "one two three four five six", "a"), (5, like[0], "a")]
    rows += [(7, like[1], "a"), (None, like[0], "a"), (None, None, "a"), (None, " ", "a")]
    got = jaccard.one_of_each(frame(spark, rows)).collect()
    wanted = [(None, rows[0][1]), (None, rows[1][1]), (0, rows[3][1]), (5, rows[4][1]), (5, like[0]), (None, None), (None, " ")]
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((str(i), str(x)) for i, x in wanted)


def test_signatures_of_a_long_text_are_counted_whole():
    words = np.random.default_rng(3).integers(0, 10**9, 400_000)
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(map(str, words)), " ".join(map(str, words[:-5])), "a b c"]})
    dealt = list(jaccard._sign(1, np.zeros(0, np.uint64))(iter([batch])))
    groups = [m for b in jaccard._meet(iter(dealt)) for m in b.column("members").to_pylist()]
    names = {jaccard.set_name(x)[0] for t in batch.column("text").to_pylist()[:2] for x in jaccard.shingle_sets(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))}
    assert [set(g) for g in groups] == [names]


def test_similar_sets_share_a_signature():
    r = np.random.default_rng(1)
    none = np.zeros(0, np.uint64)
    for n in [*range(1, 60), 100, 127, 128, 200, 511, 700, 2000]:
        a = np.unique(r.integers(0, 2**64, n, dtype=np.uint64))
        for _ in range(6):
            drop = int(r.integers(0, len(a) + 1))
            b = np.unique(np.concatenate((a[drop // 2 :], r.integers(0, 2**64, int(r.integers(0, n // 3 + 1)), dtype=np.uint64))))
            both = len(np.intersect1d(a, b))
            if both and 4 * both >= 3 * (len(a) + len(b) - both):
                for frequent in (none, a[:: 2]):
                    assert np.intersect1d(jaccard.signatures(a, frequent), jaccard.signatures(b, frequent)).size


def test_sketches_never_overstate():
    r = np.random.default_rng(2)
    for n in (1, 3, 20, 64, 130, 500):
        a = np.unique(r.integers(0, 2**64, n, dtype=np.uint64))
        for m in (0, 1, n // 4, n):
            b = np.unique(np.concatenate((a[m // 2 :], r.integers(0, 2**64, m, dtype=np.uint64))))
            if len(b):
                words = min(len(jaccard.sketch(a)), len(jaccard.sketch(b)))
                x, y = (jaccard.fold(jaccard.sketch(s)[None], words) for s in (a, b))
                assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_components(spark):
    r = random.Random(2)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        return x if root[x] == x else find(root[x])

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    assert {x.v: x.root for x in components(spark.createDataFrame(pairs, "a long, b long")).collect()} == {x: find(x) for x in root}


def vectors():
    r = np.random.default_rng(3)
    base = r.standard_normal((60, 16))
    rows = [(i, base[i % 60] + r.standard_normal(16) * (0.02 if i < 400 else 0.6), i % 2) for i in range(700)]
    rows = [(i, [float(x) for x in v], label) for i, v, label in rows]
    rows += [(700 + i, rows[3][1], 1) for i in range(30)]  # copies
    return rows + [(800, None, 1), (801, [0.0] * 16, 1), (802, [float("nan")] * 16, 1), (803, [1.0] * 15 + [None], 0), (804, rows[0][1], None), (805, [1.0, 2.0], 0), (806, [float("inf")] * 16, 0), (807, [], 1)]


@pytest.mark.parametrize("size", [32_768, 50, 1])
def test_embedding_dedup(spark, size):
    rows = vectors() if size > 1 else [(i, v, label) for i, v, label in vectors() if i % 20 < 2 or i >= 795]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumnsRenamed({})
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in hnsw.near_vectors(df, shard=size).collect()}
    truth = hnsw.brute_force(rows)
    assert {i: c for i, (_, c, _) in got.items()} == {i: c for i, (_, c) in truth.items()} and all(k == (i == c) for i, (_, c, k) in got.items())
    found, there = sum(n for n, _, _ in got.values()), sum(n for n, _ in truth.values())
    assert 0.99 * there <= found <= there


@pytest.mark.parametrize("group", [0, 900])
def test_embedding_audit_minds_pairs(group):
    r = np.random.default_rng(4)
    x = r.standard_normal((2000, 24))
    x[20:40] = x[:20] + 0.01 * r.standard_normal((20, 24))  # rare pairs
    if group:  # beside a crowd
        x[-group:] = x[-1] + 0.01 * r.standard_normal((group, 24))
    x /= np.sqrt((x * x).sum(1))[:, None]
    graph = hnsw.Graph(x)
    graph.near[0][:40] = -1  # nodes of pairs that no beam reaches, nor leaves
    for near in graph.near:
        near[np.isin(near, np.arange(40))] = -1
    assert hnsw.audited_beam(graph, 0.98) is None
    shard = hnsw._Shard(np.arange(2000), x, np.ones(2000, int), 0.98)
    got = shard.query(shard.ids, x, True).to_pylist()
    links = {o["cid"]: o["weight"] for o in got if o["other"] is None}
    truth = (x @ x.T >= 0.98).sum(1) - 1
    assert all(links.get(i, 0) == truth[i] for i in range(2000))


def test_embedding_links_found_from_one_end_count_for_both(monkeypatch):
    r = np.random.default_rng(6)
    x = np.repeat(r.standard_normal((10, 8)), 3, 0) + 0.001 * r.standard_normal((30, 8))
    shard = hnsw._Shard(np.arange(100, 130), x, np.arange(1, 31), 0.98)
    whole = lambda: {i: sum(o["weight"] for o in shard.query(shard.ids, x, True).to_pylist() if o["other"] is None and o["cid"] == i) for i in range(100, 130)}
    wanted = whole()
    assert wanted[100] == 2 + 3
    monkeypatch.setattr(shard, "_within", lambda unit: (np.arange(i, i // 3 * 3 + 3) for i in range(30)))  # later ones only
    assert whole() == wanted


def test_embedding_beams_keep_what_crowds_push_out_of_them():
    r = np.random.default_rng(8)
    x = np.concatenate([c + 0.02 * r.standard_normal((120, 16)) for c in r.standard_normal((8, 16))] + [np.repeat(r.standard_normal((320, 16)), 2, 0) + 0.01 * r.standard_normal((640, 16))])
    x = x[r.permutation(len(x))]
    x /= np.sqrt((x * x).sum(1))[:, None]
    width = hnsw.audited_beam(graph := hnsw.Graph(x), 0.98)
    assert width == hnsw.BEAM
    found, truth = list(graph.within(x, 0.98, width)), list(hnsw.all_within(x, x, 0.98))
    assert all(len(np.unique(f)) == len(f) and set(f) <= set(t) for f, t in zip(found, truth, strict=True))
    assert sum(map(len, found)) >= 0.99 * sum(map(len, truth))


def test_embedding_audit_accepts_a_graph_that_finds_pairs():
    r = np.random.default_rng(5)
    x = np.repeat(r.standard_normal((800, 16)), 2, 0) + 0.01 * r.standard_normal((1600, 16))
    x /= np.sqrt((x * x).sum(1))[:, None]
    assert hnsw.audited_beam(hnsw.Graph(x), 0.98) is not None


@pytest.mark.parametrize("size", [1, 2])
def test_embedding_shards_without_vectors_of_their_own(spark, size):
    r = np.random.default_rng(8)
    base = r.standard_normal((3, 8))
    rows = [(i, [float(x) for x in base[i % 3] + 0.01 * r.standard_normal(8)], i % 5) for i in range(50)]
    got = {x.vec_id: (x.n_links, x.component_id) for x in hnsw.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), shard=size).collect()}
    assert got == hnsw.brute_force(rows)


def test_embedding_dedup_of_null_and_repeated_ids(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(None, a, 1), (None, a, 1), (4, a, 1), (4, a, 1), (None, b, 1), (7, b, 2), (7, a, 2), (7, a, 2)]
    got = sorted((str(x.vec_id), x.n_links, str(x.component_id), x.kept) for x in hnsw.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect())
    assert got == sorted([("None", 3, "4", False)] * 2 + [("4", 3, "4", True)] * 2 + [("None", 0, "None", True)] + [("7", 0, "7", True)] + [("7", 1, "7", True)] * 2)


def test_embedding_dedup_of_nothing(spark):
    assert hnsw.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_lm_base_is_the_unigram_model(docs):
    truth = lm.brute_force_base(ROWS)
    for r in lm.score_documents(docs).collect():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == truth[r.doc_id][:4]
        assert r.base_score == pytest.approx(truth[r.doc_id][4], rel=1e-9) and r.score < 0


def lm_texts(n=60):
    """Texts of ids that follow a law: each of 40 kinds is followed by one of two others."""
    r = np.random.default_rng(0)
    out = []
    for length in (1, 2, 7, 8, 9, 47, 48, 49, 88, 89, *[400] * n):
        ids = [int(r.integers(0, 40))]
        while len(ids) < length:
            ids.append((ids[-1] * 7 + 3 + int(r.integers(0, 2))) % 40)
        out.append(np.array(ids))
    return out


def id_rows(spark, texts):
    rows = [(i, i, i, i % 7 == 2, bytearray(x.astype("<u2").tobytes())) for i, x in enumerate(texts)]
    return runtime.staged(spark.createDataFrame(rows, "rid long, did long, doc_id long, held_out boolean, ids binary"), "ids")


@pytest.fixture(scope="module")
def lm_model(spark):
    return lm.train_model(id_rows(spark, lm_texts()), classes=8)


def plain_score(model, ids):
    """The log10 probability of one text's ids, place by place, in double precision."""
    p = {n: a.astype(float) for n, a in model.net.p.items()}
    total = 0.0
    for j, i in enumerate(ids.tolist()):
        start = 0 if j < lm.WINDOW else (j - lm.WINDOW) // lm.STRIDE * lm.STRIDE + lm.STRIDE
        before = [lm.START, *ids.tolist()][start : j + 1]
        x = np.array([p["embed"][model.row[b]] + p["place"][k] for k, b in enumerate(before)])
        s = (x @ p["k"]) @ (x[-1] @ p["q"]) / np.sqrt(lm.WIDTH)
        a = np.exp(s - s.max())
        y = x[-1] + (a / a.sum()) @ (x @ p["v"]) @ p["o"]
        z = y + np.maximum(y @ p["in"] + p["in_b"], 0) @ p["out"]
        logits = z @ p["logits"] + p["bias"] + model.follow[before[-1]]
        classes = np.exp(logits - logits.max())
        shares = 10.0 ** model.within[model.of[before[-1]]]
        whole = (classes / classes.sum())[model.of[:-1]] * shares
        assert whole.sum() == pytest.approx(1, abs=1e-3)  # a distribution over all ids
        total += np.log10(whole[i])
    return total


def test_lm_score_is_the_sum_over_places(lm_model):
    texts = [t[:200] for t in lm_texts()[:12]] + [np.array([39, 1000, 50_000, 3])]
    assert lm.log_probabilities(lm_model, texts) == pytest.approx([plain_score(lm_model, t) for t in texts], rel=1e-3)


def test_lm_beats_the_unigram_of_its_ids(lm_model):
    texts = lm_texts()
    counts = np.zeros(lm.IDS)
    for i, t in enumerate(texts):
        if i % 7 != 2:
            counts += np.bincount(t, minlength=lm.IDS)
    held = [t for i, t in enumerate(texts) if i % 7 == 2 and len(t) > 20]
    unigram = np.log10((counts + 1) / (counts.sum() + lm.IDS))
    gain = (lm.log_probabilities(lm_model, held).sum() - sum(unigram[t].sum() for t in held)) / sum(map(len, held))
    assert gain > 0.9  # of log10(40) - log10(2) = 1.3


def test_lm_attention_learns_what_pairs_do_not_say():
    """Every second id is a text's own, and the ones between are the same in all: only earlier ids tell."""
    r = np.random.default_rng(2)
    own = r.integers(0, 4, (640, 1))
    ids = np.where(np.arange(lm.WINDOW + 1) % 2, 4, own)
    net = lm.Attention(5, classes=5)
    adam, prior = lm.Adam(net), np.log(np.where(np.arange(5) == 4, 1e-3, np.where(ids[:, :-1, None] == 4, 0.25, 1e-3))).astype(np.float32)
    losses = []
    for k in range(160):
        i, first = r.integers(0, 600, lm.BATCH), k % (lm.WINDOW // 16) * 16
        losses.append(adam.step(ids[i, : first + 16], first, prior[i, first : first + 16].reshape(-1, 5), ids[i, first + 1 : first + 17].ravel(), np.ones(lm.BATCH * 16)))
    likely, _ = net.forward(ids[600:, :-1], 0, prior[600:].reshape(-1, 5))
    held = -np.log(likely[np.arange(len(likely)), ids[600:, 1:].ravel()]).reshape(40, -1)[:, 2:].mean()
    assert losses[0] > 0.6 and held < 0.1


def test_lm_windows_score_each_id_once():
    for n in (1, 7, 8, 9, 47, 48, 49, 87, 88, 89, 500):
        ids = np.arange(n) % 50
        before, after, inside = lm._take(ids, lm.window_starts(n))
        inside[1:, : lm.WINDOW - lm.STRIDE] = False
        assert inside.sum() == n and after[inside].tolist() == ids.tolist() and before[0, 0] == lm.START


def test_lm_gradients():
    net = lm.Attention(9, classes=5, seed=1)
    net.p = {n: a.astype(float) for n, a in net.p.items()}
    r = np.random.default_rng(0)
    before, first = r.integers(0, 9, (3, 9)), 4
    after, prior, weight = r.integers(0, 5, 15), r.standard_normal((15, 5)), np.ones(15)
    weight[7:9] = 0

    def loss():
        likely, kept = net.forward(before, first, prior)
        return -(np.log(likely[np.arange(15), after]) * weight).sum() / weight.sum(), likely, kept

    _, likely, kept = loss()
    for name, g in net.backward(before, first, after, weight, likely, kept).items():
        at = tuple(x[0] for x in np.nonzero(np.abs(g) == np.abs(g).max()))
        net.p[name][at] += 1e-5
        up = loss()[0]
        net.p[name][at] -= 2e-5
        down = loss()[0]
        net.p[name][at] += 1e-5
        assert (up - down) / 2e-5 == pytest.approx(g[at], rel=1e-3), name


def test_lm_gradients_of_rows_that_are_not_divided_yet():
    """A step divides rows by what they sum to within its gradients, and meets keys and values only as small products."""
    net, r = lm.Attention(20, classes=7, seed=2), np.random.default_rng(4)
    before, after, prior, weight = r.integers(0, 20, (5, 11)), r.integers(0, 7, 40), r.standard_normal((40, 7)).astype(np.float32), np.ones(40, np.float32)
    qk, vo = net.folded()
    assert np.allclose(qk * np.sqrt(lm.WIDTH), net.p["q"] @ net.p["k"].T, atol=1e-5) and np.allclose(vo, net.p["v"] @ net.p["o"], atol=1e-5)
    whole, rows = (net.backward(before, 3, after, weight, *made) for made in (net.forward(before, 3, prior), (lambda likely, total, kept: (likely, kept, total))(*net.weigh(before, 3, prior))))
    assert whole.keys() == net.p.keys() == rows.keys()
    assert all(np.allclose(whole[n], rows[n], atol=1e-5) and np.abs(whole[n]).max() > 1e-4 for n in whole)


def test_lm_is_causal():
    net, r = lm.Attention(20), np.random.default_rng(0)
    before, prior = r.integers(0, 20, (2, lm.WINDOW)), np.zeros((2 * lm.WINDOW, lm.CLASSES), np.float32)
    changed = before.copy()
    changed[:, 40:] = 3
    one, two = (net.forward(b, 0, prior)[0].reshape(2, lm.WINDOW, -1) for b in (before, changed))
    assert np.allclose(one[:, :40], two[:, :40], atol=1e-6) and not np.allclose(one[:, 41:], two[:, 41:], atol=1e-3)


def test_lm_learns_from_every_window(spark, lm_model):
    texts = lm_texts(20) + [np.arange(400_000) % 40]
    assert lm.learn_all(lm_model, id_rows(spark, texts)) == sum(-(-len(x) // lm.WINDOW) for x in texts)


def test_lm_learns_from_every_id_of_a_window(lm_model, monkeypatch):
    learnt = []

    class Counted(lm.Adam):
        def step(self, before, first, prior, after, weight):
            learnt.append(weight.sum())
            return super().step(before, first, prior, after, weight)

    monkeypatch.setattr(lm, "Adam", Counted)
    texts = lm_texts(20)
    batch = pa.RecordBatch.from_arrays([pa.array([x.astype("<u2").tobytes() for x in texts], pa.binary())], ["ids"])
    for turn in range(lm.ROUNDS):
        assert len(list(lm._learn(SimpleNamespace(value=lm_model), turn)(iter([batch])))) == 1
    assert sum(learnt) == sum(map(len, texts))


def test_lm_training_windows_hold_each_id_once():
    texts = [np.arange(n) % 50 for n in (1, 63, 64, 65, 500)]
    got = [lm.training_windows(texts, turn, 3) for turn in range(3)]
    seen = np.concatenate([after[inside] for _, after, inside in got])
    assert sorted(seen.tolist()) == sorted(np.concatenate(texts).tolist())


def test_smallest_is_exact(spark):
    df = spark.range(5000).selectExpr("xxhash64(id) AS k", "id")
    for n in (1, 10, 1000, 6000):
        assert sorted(tuple(x) for x in runtime.smallest(df, "k", n).collect()) == sorted(tuple(x) for x in df.collect())[:n]


def test_mixing(docs):
    rows = mix.mix_digest(docs).collect()
    sizes = {i: len((t or "").encode().split()) for i, t in ROWS}
    by_source = {}
    for i, t in ROWS:
        by_source.setdefault(["a", "b", None, "é"][i % 4], []).append(sizes[i])
    order = sorted((s for s in by_source if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    size = {s: sum(by_source[s]) for s in order}
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    full = set()
    while True:
        level = (sum(size.values()) - sum(3 * size[s] for s in full)) / max(1, sum(weight[s] for s in order if s not in full))
        new = {s for s in order if s not in full and level * weight[s] > 3 * size[s]}
        if not new:
            break
        full |= new
    target = {s: 3.0 * size[s] if s in full else level * weight[s] for s in order}
    taken = dict.fromkeys(order, 0)
    for r in rows:
        s = ["a", "b", None, "é"][r.doc_id % 4]
        assert r.size == sizes[r.doc_id] and r.source_size == size[s] and r.target == pytest.approx(target[s]) and r.taken <= 3 * r.size
        taken[s] += r.taken
    for s in order:
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 1
    assert sorted(map(str, mix.mix_digest(docs).collect())) == sorted(map(str, rows))


@pytest.mark.parametrize("sizes", [(100, 100), (100, 5000, 3), (255, 256, 257, 1), (10_000, 40, 40, 7, 7000), (30_000, 100)])
def test_mixing_meets_the_targets_of_small_sources(spark, sizes):
    rows = [(100 * k + i, " ".join(["w"] * (n // 4 + (n % 4 if i == 3 else 0))), f"s{k}") for k, n in enumerate(sizes) for i in range(4)]
    got = mix.mix_digest(frame(spark, rows)).collect()
    for k in range(len(sizes)):
        mine = [r for r in got if r.doc_id // 100 == k]
        taken, target = sum(r.taken for r in mine), mine[0].target
        assert sum(r.size for r in mine) == sizes[k] and abs(taken - target) <= 1 + -(-sizes[k] // mix.BLOCK_WORDS), (taken, target)
        assert all(r.taken <= 3 * r.size for r in mine)


def test_mixed_documents_have_the_words_taken(docs):
    taken = {r.doc_id: r.taken for r in mix.mix_digest(docs).collect() if r.taken}
    got, out = {}, mix.mix_documents(docs)
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.encode().split())
        assert r.text in " ".join((TEXTS[r.doc_id] or "").encode().decode().split()) or len(TEXTS[r.doc_id]) > 1000
    assert got == taken and out.columns == docs.columns


def test_permutations_are_one_to_one(spark):
    targets = spark.createDataFrame([(0, 256 * 37, float(256 * 37 * 3)), (1, 256 * 5 + 1, 256 * 6.0)], "sid int, source_size long, target double")
    made = mix.blocks_of(targets, 256)
    assert {r.sid: (r.n, r.length, r.longer, r.whole, r.rest) for r in made.collect()} == {0: (37, 256, 0, 111, 0), 1: (6, 213, 3, 7, 42)}
    blocks = {}
    for r in mix.draw_slots(made, 8, 1).collect():
        blocks.setdefault((r.sid, r["pass"]), []).append(r.block)
    assert all(sorted(b) == list(range(37)) for (s, _), b in blocks.items() if s == 0) and len(blocks) == 5 and sorted(blocks[1, 0]) == list(range(6)) and len(blocks[1, 1]) == 2


def test_many_slots_are_not_broadcast(docs):
    plan = mix.mix_digest(docs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [sid" not in plan.replace("cast(sid", "sid") or "block" not in plan.split("BroadcastHashJoin [sid")[1][:40]


def corpus(n):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        words = [r.choice(WORDS) for _ in range(60)]
        kind = i % 10
        if kind == 0:
            words = [w.upper() + "!!" for w in words]
        elif kind == 1:
            words[5], words[20], words[40] = "badword", "uglyword", "badword"
        rows.append((i, " ".join(words), "a"))
        if i % 2 == 0 or kind == 1:
            labels.append((i, int(kind != 0), int(kind == 1)))
    return rows, labels


def test_resampling_keeps_target_text(spark):
    rows, labels = corpus(1500)
    got = {r.doc_id: r.kept for r in resample.resample_digest(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()}
    good = [got[i] for i, _, _ in rows if i % 10 > 1]
    bad = [got[i] for i, _, _ in rows if i % 10 <= 1]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.02


def plain_features(text):
    """The n-grams of a text as tuples, each once and once more for every doubling of its count."""
    from collections import Counter
    from itertools import groupby

    raw = text.encode().split()
    words = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in raw]
    kind = lambda b: "a" if 97 <= b <= 122 else "A" if 65 <= b <= 90 else "0" if 48 <= b <= 57 else "x" if b >= 128 else chr(b)
    shapes = ["".join(k for k, _ in groupby(map(kind, w))) for w in raw]
    grams = [("word", w) for w in words] + [("shape", s) for s in shapes] + [("shapes", *p) for p in zip(shapes, shapes[1:], strict=False)] + [("same",)] * sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [(g, level) for g, n in Counter(grams).items() for level in range(n.bit_length())]


def plain_weights(features, good):
    """The log ratio of each feature, target against raw, of texts' features by id."""
    from collections import Counter

    raw, target = (Counter(f for i in ids for f in features[i]) for ids in (features, good))
    weight = {}
    for f, n in raw.items():
        expected = len(good) * (n + 0.5) / (len(features) + 1)
        evidence = max(0.0, 2 * (target[f] * np.log(max(target[f], 1) / max(expected, 1e-9)) - target[f] + expected))
        weight[f] = np.log((target[f] + 0.5) / (expected + 0.5)) * evidence / (evidence + resample.SHRINK)
    return weight


def plain_cut(spark, features, good, bad):
    """The cut, from each labelled text's weight by the target texts of the other folds."""
    from pyspark.sql import functions as F

    ids = spark.createDataFrame([(i,) for i in [*good, *bad]], "i long")
    fold = {r.i: r.f for r in ids.select("i", F.pmod(F.xxhash64(F.xxhash64("i")), F.lit(resample.FOLDS)).alias("f")).collect()}
    weights = [plain_weights(features, [i for i in good if fold[i] != f]) for f in range(resample.FOLDS)]
    held = lambda ids: np.array([sum(weights[fold[i]][x] for x in features[i]) for i in ids])
    return resample.best_cut(held(good), held(bad))


def test_resampling_is_gumbel_top_k_of_the_two_models(spark):
    from pyspark.sql import functions as F

    r, rows, labels = random.Random(7), [], []
    for i in range(400):  # good and bad texts have the same words, more or less often
        words = [r.choice(WORDS[:50]) for _ in range(40)] + [f"bad{r.randrange(6)}" for _ in range(r.choice([0, 0, 1, 2] if i % 3 else [1, 2, 3]))]
        rows.append((i, " ".join(words) + (" é9 é9 fast-paced," if i % 7 == 0 else ""), "a"))
        if i % 2:
            labels.append((i, int(i % 3 > 0), 0))
    rows += [(900, "", "a"), (901, None, "a")]
    got = {r.doc_id: r for r in resample.resample(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()}
    features = {i: plain_features(t or "") for i, t, _ in rows}
    good = [i for i, q, x in labels if q == 1 and not x]
    weight = plain_weights(features, good)
    assert min(weight.values()) < 0 < max(weight.values())
    whole = {i: sum(weight[f] for f in fs) for i, fs in features.items()}
    for i, fs in features.items():
        assert got[i].n_ngrams == len(fs) and got[i].log_weight == pytest.approx(whole[i], abs=1e-3)
    cut = plain_cut(spark, features, good, [i for i, q, x in labels if not q or x])
    hashed = {r.i: r.h for r in spark.createDataFrame([(i, len(fs)) for i, fs in features.items()], "i long, n long").select("i", F.xxhash64("i", "n", F.lit(5)).alias("h")).collect()}
    key = {i: whole[i] - np.log(-np.log((hashed[i] % 2**52 + 0.5) / 2**52)) for i, fs in features.items() if fs}
    k = sum(whole[i] >= cut for i in key)
    drawn = set(sorted(key, key=key.get, reverse=True)[:k])
    assert {i for i, r in got.items() if r.kept} == drawn
    assert drawn != {i for i in key if whole[i] >= cut}  # a draw, not a threshold


def test_resampling_weighs_junk_of_an_unlabelled_kind(spark):
    rows, labels = corpus(1500)
    labels = [x for x in labels if not x[2]]  # the toxic kind has no label; the shouting kind has
    got = {r.doc_id: r for r in resample.resample_digest(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()}
    good = [got[i].log_weight for i, _, _ in rows if i % 10 > 1]
    toxic = [got[i].log_weight for i, _, _ in rows if i % 10 == 1]
    assert max(good) > 0 and np.quantile(toxic, 0.9) < np.quantile(good, 0.1)


def test_log_ratio_has_both_signs_and_is_shrunk():
    n = 1000.0
    got = resample.log_ratio(np.array([200.0, 0.0, 0.0, 1.0, 100.0]), n, np.array([1000.0, 1000.0, 1.0, 5.0, 1000.0]), 10_000.0)
    assert got[0] > 0.4 and got[1] < -4 and abs(got[2]) < 0.01 and abs(got[3]) < 0.05 and abs(got[4]) < 0.01


def test_top_k_is_exact(spark):
    r = np.random.default_rng(1)
    keys = np.concatenate((r.standard_normal(3000), np.full(50, 0.5), np.full(3000, -7.0)))
    rows = spark.createDataFrame([(int(i), 0, float(k)) for i, k in enumerate(keys)] + [(9999, 0, None)], "rid long, did long, key double")
    rows = runtime.staged(rows, "keys")
    for k in (0, 1, 700, 950, 3000, 3060, 4000, 6050):
        kept = [x.key for x in resample.top_k(rows, k).filter("kept").collect()]
        assert sorted(kept) == sorted(sorted(keys)[len(keys) - k :]), k


def test_cuts_leave_out_few_good_texts():
    good, bad = np.arange(100.0), np.arange(40.0, 60.0)
    cut = resample.best_cut(good, bad)
    assert (good < cut).sum() <= 100 * resample.LOST
    assert resample.best_cut(good + 100, bad) > 60 and resample.best_cut(good, np.array([])) == float("-inf")
