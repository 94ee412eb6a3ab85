"""The ten operators on small fixtures with every edge case, against brute force where there is no SQL."""

import collections
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tarmac.llm import (balanced_shards, bsi_topk, decontaminate, jaccard_tree, language_id, license_digest, packing,
                        revisits, suffix_dedup, toxicity)
from tarmac.llm.queries import QUERIES, SQL
from tarmac.llm.suffix_array import suffix_array
from tarmac.llm.winnow import Anchors

from .conftest import edge_rows, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_suffix_array_equals_sorting():
    import random

    rnd = random.Random(3)
    for _ in range(3000):
        t = [rnd.randint(0, rnd.randint(1, 4)) for _ in range(rnd.randint(0, 24))] * rnd.choice([1, 1, 3])
        assert suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("span", [80, 400])
def test_suffix_dedup_equals_brute_force(docs, span):
    raws = [(t or "").encode() for _, t, *_ in edge_rows()]
    seen = collections.Counter(r[i:i + span] for r in raws for i in range(len(r) - span + 1))
    want = []
    for (i, *_), raw in zip(edge_rows(), raws):
        gone = bytearray(len(raw))
        for k in range(len(raw) - span + 1):
            if seen[raw[k:k + span]] > 1:
                gone[k:k + span] = b"\1" * span
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        want.append((i, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in suffix_dedup.cut(docs, span).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_suffix_dedup_parts_of_a_large_block(spark, docs, monkeypatch):
    want = sorted(map(str, suffix_dedup.cut(docs, 80).collect()))
    monkeypatch.setattr(suffix_dedup, "PART", 2)
    assert sorted(map(str, suffix_dedup.cut(docs, 80).collect())) == want


def test_equal_right_sides_are_ordered_once(monkeypatch):
    asked = []
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda t: asked.append(len(t)) or suffix_array(t))
    rights = [(prose(k % 3, 60)[:200]).encode() for k in range(90)] + [b"short", b"short\0"]
    order, agree = suffix_dedup.right_order(rights, 200)
    assert asked == [5 * 4]  # five different ones of three letters and an end
    whole = [r.ljust(240, b"\0") for r in rights]
    assert sorted(order.tolist()) == list(range(92))
    for k in range(1, 92):
        x, y = whole[order[k - 1]], whole[order[k]]
        assert agree[k] == next((i for i in range(240) if x[i] != y[i]), 240)
    assert (agree < 80).sum() == len({w[:80] for w in whole})  # those with equal first letters stand together


@pytest.mark.parametrize("size", [1, 4])
def test_contexts_left_out_hold_no_repeated_string(size):
    import random

    rnd, left_out = random.Random(7), 0
    for _ in range(300):
        span, gram = rnd.randint(6, 24), 4
        reach, base = span - gram, [rnd.randint(0, 1) for _ in range(60)]
        before, contexts = [], []
        for _ in range(rnd.randint(1, 9)):
            units = [u if rnd.random() > .06 else 2 for u in base]
            b = rnd.randint(0, reach)
            before.append(b)
            contexts.append(np.array(units[30 - b:30 + rnd.randint(span - b, span)], dtype="<u4").astype(f"<u{size}").tobytes())
        want = {i for i, _, _ in suffix_dedup.repeated(np.array(before), contexts, span, size)}
        brute = set()
        for s in range(reach + 1):
            at = collections.defaultdict(list)
            for i, (b, c) in enumerate(zip(before, contexts)):
                if b >= s and len(c) // size - b >= span - s:
                    at[c[(b - s) * size:(b - s + span) * size]].append(i)
            brute.update(i for same in at.values() if len(same) > 1 for i in same)
        kept = suffix_dedup.may_repeat(before, contexts, span, reach, size)
        assert want == brute <= set(kept)
        left_out += len(contexts) - len(kept)
    assert left_out > 300


def test_words_in_passages_are_counted_for_whole_copies_only(monkeypatch):
    asked = []
    bounds = suffix_dedup.word_bounds
    monkeypatch.setattr(suffix_dedup, "word_bounds", lambda t: asked.append(len(t)) or bounds(t))
    texts = [prose(k, 70).encode() for k in range(40)]
    some = [[{"lo": 3, "hi": 60}] if k % 2 else [{"lo": 0, "hi": len(t)}] for k, t in enumerate(texts)]
    assert suffix_dedup._words_in([*texts, b""], [*some, None]) == [57 if k % 2 else 70 for k in range(40)] + [0]
    assert asked == [20]  # one call for the copies


UNSPACED = "\u0e01-\u0eff\u1000-\u107f\u1780-\u17ff\u3001-\u9fff\U00020000-\U0010ffff"


def test_anchors_of_long_texts_are_taken_in_steps():
    rng = np.random.default_rng(4)
    texts = [rng.integers(97, 123, n, dtype=np.uint8).tobytes() for n in (50, 3000, 0, 79, 700, 80)] + [b"ab" * 400, b"z" * 200]
    want = [x.tolist() for x in Anchors(80)(texts)]
    assert len(want[0]) > 100
    for step in (1, 7, 80, 1000, 5000):
        assert [x.tolist() for x in Anchors(80, step=step)(texts)] == want
    # a text of more than 16 MiB, and windows of it alone
    long = rng.integers(97, 123, (1 << 24) + 5000, dtype=np.uint8).tobytes()
    owner, place, fp = Anchors(400)([b"first", long])
    assert set(owner.tolist()) == {1} and (np.diff(place) > 0).all() and np.diff(place).max() <= 400
    some = {(p, f) for p, f in zip(place.tolist(), fp.tolist())}
    for lo in (0, (1 << 21) - 300, (1 << 24) - 300):
        part = [x.tolist() for x in Anchors(400)([long[lo:lo + 1500]])]
        assert part[1] and {(lo + p, f) for p, f in zip(*part[1:])} <= some


def _word_rows():
    """A passage of 51 words in 101 bytes, one of 50 long words, other white space, characters as words."""
    short, fifty = " ".join("abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJKLMNO"), " ".join(["wordsoftwelve", "longerthanthat"] * 25)
    assert len(short.split()) == 51 and len(fifty.split()) == 50 and len(fifty) > 600
    han = "".join(chr(0x4E00 + 37 * i) for i in range(60))
    rows = [(i, t) for i, (t, *_) in enumerate(r[1:] for r in edge_rows())]
    for i in range(3):
        rows.append((100 + i, f"{prose(20 + i, 30)} {short} {prose(30 + i, 20)} end{i}"))
        rows.append((200 + i, f"{prose(40 + i, 30)} {fifty} {prose(50 + i, 20)}"))
        rows.append((300 + i, f"{prose(60 + i, 9)}{han}x{prose(70 + i, 9)}\u0e01\u0e02 z"))
        rows.append((400 + i, ["\n", " \u00a0\t", "\u3000"][i].join(f"gap{k}" for k in range(52))))
        rows.append((500 + i, " ".join(f"gap{k}".upper() for k in range(52)) + f" {i}" * (2 * i)))
    return rows


@pytest.mark.parametrize("span", [20, 51])
def test_suffix_dedup_over_words_equals_brute_force(spark, span):
    words = [[(m.start(), m.group()) for m in re.finditer(f"[{UNSPACED}]|[^\\s{UNSPACED}]+", t or "")] for _, t in _word_rows()]
    seen = collections.Counter(tuple(w for _, w in x[k:k + span]) for x in words for k in range(len(x) - span + 1))
    want, repeated = [], []
    for (i, t), x in zip(_word_rows(), words):
        gone = [False] * len(x)
        for k in range(len(x) - span + 1):
            if seen[tuple(w for _, w in x[k:k + span])] > 1:
                gone[k:k + span] = [True] * span
        repeated.append((i, sum(gone)))
        at = [0, *(a for a, _ in x[1:]), len(t or "")]
        kept = "".join(t[at[k]:at[k + 1]] for k in range(len(x)) if not gone[k]) if any(gone) else t or ""
        want.append((i, kept, sum(1 for k in range(len(x)) if gone[k] and (k == 0 or not gone[k - 1]))))
    df = spark.createDataFrame(_word_rows(), "doc_id long, text string")
    out = suffix_dedup.cut(df, span, keep_all=True, unit=suffix_dedup.WORDS).collect()
    assert sorted((r["doc_id"], r["_kept_text"], r["_n_spans"]) for r in out) == sorted(want)
    counted = suffix_dedup.cut(df, 400, passage=span).collect()
    assert sorted((r["doc_id"], r["n_repeated_words"]) for r in counted) == sorted(repeated)
    assert [r[:-1] for r in sorted(map(tuple, counted))] == sorted(map(tuple, suffix_dedup.cut(df, 400).collect()))


def test_repeats_stage_counts_words(spark):
    import corpus_pipeline as c

    out = {r["doc_id"]: r["text"] for r in c.cut_repeats(spark, spark.createDataFrame(_word_rows(), "doc_id long, text string"), "").collect()}
    assert out[100] == prose(20, 30) + " " + prose(30, 20) + " end0"  # 51 words of one letter
    assert out[200] == dict(_word_rows())[200]  # 50 long words stay


def _brute_topk(rows, k, is_query):
    kept = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (a, x) in enumerate(kept):
        if is_query(a):
            s = sorted((-sum(m * n for m, n in zip(x, y)), b) for j, (b, y) in enumerate(kept) if j != at and len(y) == len(x))[:k]
            out += [(a, r + 1, b, -v) for r, (v, b) in enumerate(s)]
    return sorted(out)


def test_topk_equals_brute_force_with_ties_nulls_and_repeats(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.3, 6)]) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [rows[5], rows[5], rows[10], (20, rows[7][1]), (20, rows[8][1]), (21, rows[8][1])]
    rows += [(30, [-x for x in rows[30][1]])] + [(40, rows[41][1])] * 30
    rows += [(2000, None), (2001, [float("nan")] * 6), (2002, [None] + [0.1] * 5), (2003, [float("inf")] * 6),
             (None, [0.1] * 6), (2010, [0.5, 0.5]), (2020, [0.5, -0.5]), (2030, []), (2040, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = bsi_topk.topk(df, F.col("id") % 10 == 0, 5, block_rows=64, query_bytes=400)
    assert sorted(tuple(r) for r in got.collect()) == _brute_topk(rows, 5, lambda i: i % 10 == 0)
    duckdb.sql("CREATE OR REPLACE TEMP TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    duckdb.default_connection().executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    assert sorted(duckdb.sql(bsi_topk.SQL).fetchall()) == _brute_topk(rows, 5, lambda i: i % 50 == 0)
    assert bsi_topk.topk(df.limit(0), F.col("id") % 10 == 0).count() == 0


def test_language_id_held_out_accuracy_and_edges(spark, docs, no_docs):
    got = QUERIES["op3_language_id"](spark, SF_SMALL.replace("0.001", "0.01")).join(
        spark.read.parquet(SF_SMALL.replace("0.001", "0.01") + "/documents.parquet").select("doc_id", "lang"), "doc_id")
    ok, n = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert ok > 0.97 and n > 200
    model = language_id.learn(docs)
    assert model.langs == ["en"] and language_id.learn(no_docs) is None
    out = language_id.identify(docs, model).collect()
    want = [("en" if t and re.search(r"[^\W\d_]", t) else "und") for _, t, *_ in edge_rows()]
    assert sorted(r["lang_pred"] for r in out) == sorted(want)
    assert all(r["score"] == 0 for r in out if r["lang_pred"] == "und")
    assert {r["lang_pred"] for r in language_id.identify(docs, None).collect()} == {"und"}
    assert language_id.identify(no_docs, model).count() == 0


def test_codewords_differ_for_any_number_of_languages():
    for k in (1, 2, 3, 5, 9, 40):
        code = language_id.codewords([f"l{i}" for i in range(k)])
        assert code.shape[0] == k and len({tuple(r) for r in code}) == k


@pytest.mark.parametrize("n", [0, 1])
def test_shards_follow_the_rows_law_and_keep_groups(spark, docs, no_docs, n):
    got = balanced_shards.assign([no_docs, docs][n]).toPandas()
    assert len(got) == n * len(edge_rows())
    if n:
        _check_law(got, edge_rows())


def _check_law(got, rows):
    sizes = got.groupby("shard").size().reindex(range(8), fill_value=0)
    assert sizes.max() - sizes.min() <= 1
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    want = sorted((-1 if i is None else i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert sorted(zip(got["doc_id"].fillna(-1).astype(int), got["size"], got["text_crc32"])) == want


def test_shards_with_a_group_of_a_third_and_only_linked_rows(spark):
    rows = [(i, "same" if i % 3 == 0 else f"text {i // 2}", "", "", 0, "") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, extra string")
    got = balanced_shards.assign(df).toPandas()
    _check_law(got, rows)
    text = {i: t for i, t, *_ in rows}
    got["text"] = got["doc_id"].map(text)
    spread = got.groupby("text")["shard"].nunique()
    assert spread["same"] <= 5 and (spread.drop("same") > 1).mean() < 0.05
    rows = [(i, f"t{i // 2}", "", "", 0, "") for i in range(100)]
    _check_law(balanced_shards.assign(spark.createDataFrame(rows, df.schema)).toPandas(), rows)


def test_toxicity_chain_finds_held_out_and_handles_edges(spark, docs, no_docs):
    sf = SF_SMALL.replace("0.001", "0.1")
    d, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    chain = toxicity.learn(d, labels.filter("doc_id % 2 = 0"), toxicity.categories())
    out = toxicity.score(d, chain).withColumnRenamed("toxic", "flag").join(labels.filter("doc_id % 2 = 1"), "doc_id").toPandas()
    assert out[out["toxic"] == 1]["flag"].mean() > 0.8 and out[out["toxic"] == 0]["flag"].mean() < 0.005
    edge = toxicity.score(docs, chain).collect()
    assert len(edge) == len(edge_rows()) and not any(r["toxic"] for r in edge if r["doc_id"] in (3, 4, 5, 6, 7, 14))
    assert toxicity.score(no_docs, chain).count() == 0
    none = toxicity.learn(docs, labels.limit(0), toxicity.categories())
    assert toxicity.kept(docs, none).columns == docs.columns and toxicity.kept(docs, none).count() == len(edge_rows())
    one = spark.createDataFrame([(0, 1, 0), (0, 1, 0), (1, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.kept(docs, toxicity.learn(docs, one, toxicity.categories())).count() == len(edge_rows())


def test_revisits_statuses_ties_and_skew(spark):
    h = {"Content-Type": "text/html", "Date": "d0", "ETag": "e"}
    rows = [
        (1, "http://a.org/x/", 10, "response", '"e1"', None, None, h),
        (2, "HTTPS://www.A.org/x?utm_source=q#f", 20, "revisit", 'W/"e1"', None, None, {"date": "d1", "content-type": "no"}),
        (3, "a.org/x", 10, "revisit", '"e1"', None, None, None),  # a response of the same time is not earlier
        (4, "a.org/x", 30, "response", '"e2"', "m", None, None),
        (5, "a.org/x", 40, "revisit", '"e1"', None, None, None),
        (6, "a.org/x", 41, "revisit", None, None, None, None),
        (7, "a.org/x", 42, "revisit", None, "m", None, {"Vary": "v", "x": None}),
        (8, None, 1, "revisit", None, None, None, None), (9, "b", None, "response", None, None, None, None),
        (7, "a.org/x", 42, "revisit", None, "m", None, {"Vary": "v", "x": None}),
    ]
    schema = "record_id long, url string, ts long, kind string, etag string, last_modified string, digest string, headers map<string,string>"
    df = spark.createDataFrame(rows, schema)
    for per_slice in (2, 100):
        got = sorted(((r["record_id"], r["status"], r["response_id"], r["headers"]) for r in revisits.resolve(df, per_slice).collect()), key=str)
        assert got == sorted([
            (2, "resolved", 1, {"Content-Type": "text/html", "ETag": "e", "date": "d1"}), (3, "no_response", None, None),
            (5, "mismatch", 4, None), (6, "unverified", 4, None), (7, "resolved", 4, {"Vary": "v"}), (7, "resolved", 4, {"Vary": "v"}),
        ], key=str)
    assert revisits.resolve(df.limit(0)).count() == 0


def test_packing_is_an_exact_round_trip(docs, no_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    got = packing.pack_documents(docs, keep_ids=True).toPandas()
    whole = {}
    for i, t, *_ in edge_rows():
        whole.setdefault(-1 if i is None else i, []).append(tok.encode(t or "", add_special_tokens=False).ids + [2])
    for i, part in got.groupby(got["doc_id"].fillna(-1)):
        copies = len(whole[i])
        ids = np.concatenate([np.frombuffer(b, dtype="<u4") for b in part.sort_values("start")["ids"].iloc[::copies]])
        assert ids.tolist() == whole[i][0]
        assert all(c == zlib.crc32(b) for c, b in zip(part["ids_crc32"], part["ids"]))
    for _, seq in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert seq["offset"].tolist() == [0, *seq["length"].cumsum().tolist()[:-1]] and seq["length"].sum() <= 4096
    assert packing.pack_documents(no_docs).count() == 0


def test_word_encoder_equals_the_tokenizer():
    import random

    import public_tokenizers

    e = packing.WordEncoder(public_tokenizers.path(packing.TOKENIZER))
    rnd, letters = random.Random(0), list("aB'sSréRÉ.,-3²_ß$ä Σσİª́ \x1c")
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 9))) for _ in range(5000)]
    for t in [*texts, "a<|endoftext|>b", "<|startoftext|>", "don't 'S \"Hello\" (x)"]:
        assert np.frombuffer(e.text(t), dtype="<u4").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids, t


def test_texts_are_encoded_together_and_each_part_once(monkeypatch):
    import random

    import public_tokenizers

    e = packing.WordEncoder(public_tokenizers.path(packing.TOKENIZER))
    asked, real = [], e.encode_parts
    monkeypatch.setattr(e, "encode_parts", lambda parts: asked.extend(parts) or real(parts))
    signs = ["", ",", ".", "!!", "\"", "(", ")", "***", "'s", "'LL", "7"]
    texts = [a + w + b for w in ("harbor", "HARBOR", "Harbor", "größe", "GRÖSSE", "Größe") for a in signs for b in signs]
    rnd = random.Random(4)
    letters = ["a", "S", "r", "e", "L", "l", "'", "9", "½", "É", "ß", ".", "$", " ", "\n", "\x0b", "\x1c", "\x00", "\x85", "\xa0", "\xad",
               "’", "Σ", "ſ", "日", "<|", "<|endoftext|>", "A", "B", "Ω", "\u0301"]
    texts += ["".join(rnd.choices(letters, k=rnd.randint(0, 12))) for _ in range(4000)]
    for _ in range(2):
        ids, ends = e.texts(texts, np.array([2], dtype="<u4").tobytes())
        for t, a, b in zip(texts, [0, *ends.tolist()], ends.tolist()):
            assert ids[a:b].tolist() == [*e.tokenizer.encode(t, add_special_tokens=False).ids, 2], t
    assert len(asked) == len(set(asked)) and asked.count(b"harbor") == 1
    words = [b"harbor", "größe".encode("latin-1"), b"'s", b"***", b"7"]
    whole = e.encode_parts(words)
    e.closes[:] = False  # as in a vocabulary without closing suffixes
    assert e.encode_parts(words) == whole and e.encode_parts([]) == []


def test_a_long_text_and_its_neighbours_keep_their_pieces(spark, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(packing, "STRETCH", 500)
    e = packing.WordEncoder(public_tokenizers.path(packing.TOKENIZER))
    texts = ["one two", "It's a big, long text. " * 200, "", "x" * 1500, "\u65e5\u672c \u2019s " * 300, "end"]
    for t in texts:
        assert np.frombuffer(e.text(t), dtype="<u4").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids
    assert e.texts([""])[1].tolist() == [0]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r for r in packing.pieces(docs, keep_ids=True).collect()}
    assert {i: np.frombuffer(r["ids"], dtype="<u4").tolist() for i, r in got.items()} == {
        i: [*e.tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}


def test_plan_uses_every_piece_once_with_little_padding():
    rng = np.random.default_rng(2)
    for sizes in (rng.integers(1, 129, 5000), np.full(3000, 128), rng.integers(1, 4, 4000), np.array([256] * 5 + [1])):
        h = dict(collections.Counter(sizes.tolist()))
        out, used = packing.plan(h, 256), collections.Counter()
        for combo, times in out:
            assert sum(u * k for u, k in combo.items()) <= 256 and times > 0
            for u, k in combo.items():
                used[u] += k * times
        assert dict(used) == h
        windows = sum(t for _, t in out)
        assert windows <= sum(sizes) / 256 * 1.02 + 2


def test_packing_of_short_texts_pads_little(spark):
    rows = [(i, " ".join(["word"] * (1 + i * 7 % 9))) for i in range(20_000)] + [(i, "one two") for i in range(5)] * 2
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    assert len(got) == len(rows) and got["length"].max() < 20
    by = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    for _, seq in by:
        assert seq["offset"].tolist() == [0, *seq["length"].cumsum().tolist()[:-1]] and seq["length"].sum() <= 4096
    assert got["length"].sum() >= 0.97 * 4096 * by.ngroups


def test_plan_of_short_and_long_pieces_pads_little():
    rng = np.random.default_rng(5)
    for lengths in (rng.integers(1, 256, 20_000), rng.integers(1, 2048, 100_000), rng.lognormal(4, 1.5, 50_000).astype(int) % 2047 + 1):
        size = np.where(lengths < packing.FINE, lengths, -(-lengths // packing.STEP) * packing.STEP)
        out = packing.plan(dict(collections.Counter(size.tolist())), 4096)
        assert sum(t * k for combo, t in out for k in combo.values()) == len(lengths)
        assert sum(t for _, t in out) * 4096 <= lengths.sum() * 1.02 + 4096


def test_nnls_beats_zero_and_is_non_negative():
    rng = np.random.default_rng(0)
    a, truth = rng.random((12, 30)), np.maximum(0, rng.normal(size=30))
    x = packing.nnls(a, a @ truth)
    assert (x >= 0).all() and np.allclose(a @ x, a @ truth, atol=1e-6)


def test_license_digests_match_spellings_lines_and_edges(spark, no_docs):
    mit = dict(license_digest.KNOWN)["MIT"]
    texts = [mit, "Copyright (c) 2020 X\n" + mit.upper().replace("SUBLICENSE", "sub-licence".replace("-", "")), mit + " more",
             "Released under the MIT License", "text\nReleased under the MIT licence.\nmore", "", None, "Copyright notes", mit]
    df = spark.createDataFrame([(i % 8, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = license_digest.scan(df, license_digest.known_digests(spark)).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append((r["license_id"], r["line_licenses"]))
    assert len(got) == len(texts) and by[0] == [("MIT", "")] * 2 and by[1] == [("MIT", "")] and by[2] == [(None, "")]
    assert by[3] == [("MIT-notice", "MIT-notice")] and by[4] == [(None, "MIT-notice")] and by[6] == [(None, "")]
    assert license_digest.scan(no_docs, license_digest.known_digests(spark)).count() == 0


def test_whole_public_licenses_are_known_with_their_titles(spark, tmp):
    import duckdb
    from pathlib import Path

    shipped = sorted(Path(license_digest.__file__).parent.joinpath("licenses").glob("*.txt"))
    rows = [(p.stem, p.read_text()) for p in shipped]
    assert len(rows) == 14
    rows += [(n, t.upper().replace("\n", "\n\n  ")) for n, t in rows]
    apache, gpl, bsd, mit = (dict(rows[:14] + license_digest.KNOWN)[n] for n in ("Apache-2.0", "GPL-2.0", "BSD-3-Clause", "MIT"))
    rows += [("Apache-2.0", apache.split("   END OF TERMS")[0]), ("Apache-2.0", apache[apache.index("TERMS AND"):]),
             ("GPL-2.0", gpl.split("\t    How to Apply")[0].split("            How to Apply")[0]),
             ("GPL-2.0", gpl.replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "59 Temple Place - Suite 330, Boston, MA 02111-1307, USA")),
             ("GPL-2.0", gpl.replace("an appropriate\ncopyright notice", "an appropriate copyright\nnotice")),
             ("MIT", "MIT License\n\nCopyright (c) 2021 Someone\n\n" + mit), ("MIT", "The MIT Licence (MIT)\nCopyright 2021 X\nAll rights reserved.\n" + mit),
             ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, X\n" + bsd.split("\n", 1)[1]
              .replace("the University nor", "the copyright owner nor").replace("THE REGENTS AND", "THE COPYRIGHT HOLDERS AND")
              .replace("THE REGENTS OR", "THE COPYRIGHT OWNER OR").replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")),
             (None, apache.replace("perpetual", "brief")), (None, "MIT License")]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r["license_id"] for r in license_digest.scan(df, license_digest.known_digests(spark)).collect()}
    assert [got[i] for i in range(len(rows))] == [n for n, _ in rows]
    df.write.parquet(tmp + "/documents")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp}/documents/*.parquet'")
    assert dict(con.execute(f"select doc_id, license_id from ({license_digest.SQL})").fetchall()) == got


def test_licenses_are_known_at_every_width(spark):
    import textwrap
    from pathlib import Path

    rows = []
    for p in sorted(Path(license_digest.__file__).parent.joinpath("licenses").glob("*.txt")):
        parts = re.split(r"\n[ \t\f]*\n", p.read_text().replace("\f", "\n"))
        rows += [(p.stem, w, "\n\n".join(textwrap.fill(x, w, break_long_words=False) for x in parts)) for w in range(50, 121, 5)
                 if p.stem != "BSD-3-Clause" or w >= 60]  # its statement alone has 59 characters
    mit = dict(license_digest.KNOWN)["MIT"]
    rows += [("MIT", w, "Copyright (c) 2020 A Person\n\n" + "\n\n".join(textwrap.fill(x, w) for x in mit.split("\n"))) for w in range(50, 121)]
    df = spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r["license_id"] for r in license_digest.scan(df, license_digest.known_digests(spark)).collect()}
    assert [] == [(n, w) for i, (n, w, _) in enumerate(rows) if got[i] != n]


def _brute_hits(texts, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wins = collections.defaultdict(set)
    for i, t in items:
        w = word.findall((t or "").translate(LOWER))
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins[tuple(w[k:k + n])].add(str(i))
    out = []
    for d, t in texts:
        w, hit, ids = word.findall((t or "").translate(LOWER)), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if found := wins.get(tuple(w[k:k + n])):
                    ids |= found
                    hit |= set(range(k, k + n))
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [decontaminate.BROADCAST_ROWS, 10, 0])
def test_decontamination_equals_brute_force(spark, docs, no_docs, most, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", most)
    items = [(1, prose(1, 20)), (10, prose(1, 20)), (2, "one two"), (3, None), (4, "?!"), (5, "Café İstanbul"), (9, prose(9, 14))]
    windows = decontaminate.benchmark_windows(spark.createDataFrame(items, "item_id long, text string"))
    got = decontaminate.find(docs, windows).drop("spans", "text_md5").collect()
    assert sorted((tuple(r) for r in got), key=str) == _brute_hits([r[:2] for r in edge_rows()], items)
    kept = decontaminate.clean(docs, windows)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r["contaminated"] for r in got)
    none = decontaminate.benchmark_windows(spark.createDataFrame([], "item_id long, text string"))
    assert decontaminate.find(docs, none).filter("contaminated").count() == 0 and decontaminate.find(no_docs, windows).count() == 0


def _brute_groups(rows, width, num, den):
    word, sets = re.compile(r"[^\x20\x09-\x0D]+"), []
    for _, t in rows:
        w = word.findall((t or "").translate(LOWER))
        sets.append({tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [(i, len(s), least.get(find(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("rule", [(4, 85), (5, 80)])
def test_jaccard_groups_equal_brute_force(spark, docs, no_docs, rule, monkeypatch):
    r = jaccard_tree.Rule(rule[0], rule[1], 100)
    key = lambda x: sorted(x, key=str)
    got = [tuple(x)[:3] for x in jaccard_tree.group(docs, rule=r).collect()]
    assert key(got) == key(_brute_groups([x[:2] for x in edge_rows()], rule[0], rule[1], 100))
    assert jaccard_tree.group(no_docs, rule=r).count() == 0
    # a family of near copies around the threshold, a shared passage, and blocks cut into parts
    base, rows = prose(7, 90).split(), []
    for i in range(120):
        w = list(base)
        for k in range(i % 7):
            w[(i * 13 + k * 29) % 90] = f"changed{i}x{k}"
        rows.append((i, " ".join(w)))
    rows += [(200 + i, prose(50 + i, 60) + " " + " ".join(base[:50])) for i in range(40)]
    monkeypatch.setattr(jaccard_tree, "BLOCK", 30)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(x)[:3] for x in jaccard_tree.group(df, rule=r).collect()]
    assert key(got) == key(_brute_groups(rows, rule[0], rule[1], 100))


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_with_sql_equal_duckdb(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    want, got = con.execute(SQL[name]).df(), QUERIES[name](spark, SF_SMALL).toPandas()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)

    def rows(d):
        return sorted(map(repr, d[cols].astype(object).where(d[cols].notna(), None).itertuples(index=False, name=None)))

    assert rows(got) == rows(want)


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    import corpus_pipeline as c
    from tarmac.llm.common import stored

    docs = first = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, stage in c.STAGES[:-1]:
        after = stored(stage(spark, docs, SF_SMALL), "stage")
        assert after.columns == first.columns and 0 < after.count() <= docs.count()
        docs = after
    packed = c.STAGES[-1][1](spark, docs, SF_SMALL)
    assert packed.select("doc_id").distinct().count() == docs.count() and c.run(spark, SF_SMALL).count() == packed.count()
    empty = first.limit(0)
    for _, stage in c.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0


def test_near_copies_with_null_and_repeated_ids_lose_no_other_text(spark):
    base = prose(91, 60)
    rows = [(None, base), (None, base + " more"), (None, prose(92, 60)), (None, prose(93, 60)), (None, "short"),
            (1, prose(94, 60)), (1, prose(95, 60)), (1, prose(94, 60)), (2, prose(95, 60) + " more"), (None, None), (3, None)]
    kept = jaccard_tree.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), rule=jaccard_tree.Rule(5, 80, 100))
    got = collections.Counter(tuple(r) for r in kept.collect())
    assert sum(got[r] for r in rows[:2]) == 1
    assert got - collections.Counter(rows[:2]) == collections.Counter([*rows[2:7], (None, None), (3, None)])


def test_near_copies_deal_out_the_texts_once(spark, docs):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = jaccard_tree.one_of_each(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    sides = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len(sides) == 2, plan  # the texts and the rows that stay; no further one for the repeated rows


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    from pathlib import Path

    from tarmac.llm import common

    env = spark._jvm.org.apache.spark.SparkEnv.get()
    folders = [Path(d.toString()) for d in env.blockManager().diskBlockManager().localDirs()]

    def shuffled():
        return {f for d in folders for f in d.rglob("shuffle_*.data")}

    before, was = shuffled(), spark.conf.get(common.RELEASE)
    for write in (common.Scratch(spark, "release").stored, common.stored):
        rows = write(spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count(), "t")
        assert rows.count() == 7
    left = [f for f in shuffled() - before if f.stat().st_size > 200]  # the counts above leave a few bytes
    assert not left
    assert spark.conf.get(common.RELEASE) == was


def test_near_copies_leave_one_document_each(docs):
    kept = jaccard_tree.one_of_each(docs, rule=jaccard_tree.Rule(5, 80, 100)).toPandas()
    assert kept.columns.tolist() == docs.columns
    ids = sorted(kept["doc_id"].dropna().astype(int))
    assert 0 in ids and 1 not in ids and 2 not in ids and ids.count(15) == 1 and {3, 4, 5, 6, 7} <= set(ids)


def test_cut_texts_keep_nulls_and_lengths(docs):
    out = suffix_dedup.cut_texts(docs, 80).toPandas()
    assert out.columns.tolist() == docs.columns and out["text"].isna().sum() == 2
    one = out[out["doc_id"] == 1].iloc[0]
    assert one["text"] == "" and one["n_chars"] == 0


def test_stages_keep_columns_named_like_their_own(spark):
    """Extra columns with every name that the stages use inside come through unchanged."""
    import corpus_pipeline

    names = ["_text", "text2", "_key", "_hash", "key", "hash", "h", "_h", "_id", "id", "_md5", "md5", "_spans", "spans", "_n_bytes", "n_bytes",
             "n_removed", "_kept_text", "kept_text", "th", "_th", "_th2", "th2", "row", "flag", "_flag", "_p0", "p0", "p1", "n_words", "a.b", "contaminated"]
    rows = [(i, t, "en", "s", len(t) if t else None, *[f"{c}{i}" for c in names]) for i, t, *_ in edge_rows()]
    columns = ", ".join(["doc_id long, text string, lang string, source string, n_chars long", *[f"`{c}` string" for c in names]])
    docs = spark.createDataFrame(rows, columns)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert got, name
        for r in got:
            assert list(r)[5:] == [f"{c}{r['doc_id']}" for c in names], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() >= len(rows)


def test_a_family_just_under_the_threshold_is_searched_in_steps():
    """Sizes of the steps are bounded, and no pair that links is lost in them."""
    rng = np.random.default_rng(5)
    rule = jaccard_tree.Rule()
    common = rng.integers(0, 1 << 62, 200, dtype=np.int64).astype(np.uint64)
    sets = [np.unique(np.concatenate([common[: 180 + i % 21], rng.integers(0, 1 << 62, 12, dtype=np.int64).astype(np.uint64)])) for i in range(700)]
    sets.sort(key=len)
    n = np.array([len(s) for s in sets])
    bits = np.stack([jaccard_tree.bitmap(s, rule.bits) for s in sets]).view("<u8")
    steps = list(rule.traverse(n, bits, np.arange(len(n))))
    assert max(len(a) for a, _ in steps) <= jaccard_tree.STEP
    found = {(int(x), int(y)) for a, b in steps for x, y in zip(a, b)}
    for i in range(0, 700, 7):
        for j in range(i + 1, 700, 5):
            shared = len(np.intersect1d(sets[i], sets[j]))
            if 100 * shared >= 85 * (len(sets[i]) + len(sets[j]) - shared):
                assert (i, j) in found
