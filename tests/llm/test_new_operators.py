"""Token alignment, conversation repair and the quality classifier against brute force and held-out labels."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
CLASHING = ("id", "row", "a", "b", "x", "y", "fold", "of", "score", "conv", "turn_", "n", "copy", "same", "c", "s", "first",
            "part", "seg", "pos", "code", "pair", "bucket", "text_", "kind", "__id")


def with_clashes(df):
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHING])


@pytest.fixture(scope="module")
def odd_docs(spark):
    texts = [(1, "Hello wörld, hello!"), (1, "Hello wörld, hello!"), (2, None), (3, ""), (None, "no id"), (4, " \n\t "),
             (5, "▁ piece mark"), (6, "<|endoftext|> <s> <0x41>"), (7, "\U0001F600中文 Nul \x00 byte"),
             (8, " ".join(f"w{k}" for k in range(30_000))), (9, "x" * 3_000), (10, "  two  spaces "), (1, "other text, same id")]
    return with_clashes(spark.createDataFrame(texts, "doc_id long, text string")).repartition(3)


# --- perfect hash ---------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash_is_minimal(n):
    from ampere.llm.perfect_hash import PerfectHash, build
    keys = np.random.default_rng(n).choice(10 ** 12, n, replace=False)
    h = PerfectHash([build(keys)])
    assert sorted(h.slots(keys)) == list(range(n))
    assert (h.slots(keys + 10 ** 12) < max(n, 1)).all()


def test_perfect_hash_of_buckets():
    from ampere.llm.perfect_hash import PerfectHash, bucket_of, build
    keys = np.arange(20_000) * 7919
    at = bucket_of(keys, 64)
    h = PerfectHash([build(keys[at == k]) for k in range(64)])
    assert sorted(h.slots(keys)) == list(range(len(keys)))
    with pytest.raises(ValueError, match="distinct"):
        build(np.array([5, 5]))


# --- 11 token alignment ---------------------------------------------------

@pytest.fixture(scope="module")
def paths():
    from ampere.llm.queries import tokenizer_path
    return tokenizer_path(), tokenizer_path("piece_bpe_32k.model")


def align_brute(rows, paths):
    """By the contract, token by token, with the libraries' own readers."""
    import sentencepiece
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(paths[0])
    tok.encode_special_tokens = True
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}
    sp = sentencepiece.SentencePieceProcessor(model_file=paths[1])
    docs, counts = [], Counter()
    for i, t in rows:
        groups = []
        if t:
            ids_a, ids_b = tok.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)
            bytes_a = [bytes(byte[c] for c in tok.id_to_token(k)) for k in ids_a]
            bytes_b = [bytes([int(sp.id_to_piece(k)[3:5], 16)]) if sp.is_byte(k)
                       else sp.id_to_piece(k).replace("▁", " ").encode() for k in ids_b]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + t).encode():
                ends_a, ends_b = (list(itertools.accumulate(map(len, x))) for x in (bytes_a, bytes_b))
                both = set(ends_a) & set(ends_b)
                a = b = 0
                for e in sorted(both):
                    a2, b2 = ends_a.index(e, a) + 1, ends_b.index(e, b) + 1
                    groups.append((ids_a[a:a2], ids_b[b:b2]))
                    a, b = a2, b2
        counts.update((a[-1], b[-1]) for a, b in groups)
        docs.append((i, groups))
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for i, groups in docs:
        links = [(a[-1], b[-1]) for a, b in groups]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                    sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


@pytest.mark.parametrize("broadcast_pairs", [2_000_000, 0])
@pytest.mark.parametrize("which", ["table", "odd", "nothing"])
def test_alignment_equals_brute_force(spark, odd_docs, paths, which, broadcast_pairs):
    from ampere.llm.token_align import align_documents
    df = {"table": spark.read.parquet(f"{SMALL}/documents.parquet").limit(60), "odd": odd_docs,
          "nothing": odd_docs.filter("false")}[which]
    out = align_documents(df, *paths, broadcast_pairs=broadcast_pairs)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, out.collect()), key=repr) == align_brute(df.select("doc_id", "text").collect(), paths)


def test_alignment_tree_of_many_tasks(spark, paths, monkeypatch):
    from ampere.llm import token_align
    monkeypatch.setattr(token_align, "FAN_IN", 2)
    monkeypatch.setattr(token_align, "BUCKETS", 3)
    df = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", F.substring("text", 1, 80).alias("text")).repartition(7)
    got = sorted(map(tuple, token_align.align_documents(df, *paths).collect()), key=repr)
    assert got == align_brute(df.collect(), paths)


# --- 12 conversation repair -----------------------------------------------

GOOD = re.compile(r"(s?(ua)+)?\Z")


def cheapest(rows):
    """(cost, audit, messages) by trying every sequence of edits with one insertion at most before each row and the end."""
    best = None

    def go(k, roles, cost, audit, said):
        nonlocal best
        if best and cost > best[0]:
            return
        for insert in ("", "u", "a"):
            r, c, a, m = roles + insert, cost + 3 * bool(insert), audit + "I" * bool(insert), list(said)
            if insert:
                m.append({"u": "user:", "a": "assistant:"}[insert])
            if k == len(rows):
                if GOOD.match(r) and (best is None or (c, a) < best[:2]):
                    best = (c, a, m)
                continue
            role, text, fault = rows[k]
            go(k + 1, r, c + 4, a + "D", m)
            if fault not in ("blank", "duplicate"):
                add = 3 * (fault == "truncated")
                go(k + 1, r + (role[:1] or "?"), c + add, a + "K", [*m, f"{role}:{text}"])
                for x in ("user", "assistant"):
                    go(k + 1, r + x[0], c + 3 + add, a + "R", [*m, f"{x}:{text}"])

    go(0, "", 0, "", [])
    return best


def dynamic(rows):
    """The same by dynamic programming over whole strings, for long conversations."""
    state = {"": (0, "", ())}  # what stands before: nothing, s, u, a
    need = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def inserted(state):
        out = dict(state)
        for _ in range(3):
            for p, (c, a, m) in list(out.items()):
                q = need[p]
                out[q] = min(out.get(q, (9 ** 9,)), (c + 3, a + "I", (*m, f"{name[q]}:")))
        return out

    def variants(state):  # insertions need not be worth it for their own state: keep every (state, number)
        return [(p, c + 3 * k, a + "I" * k, m) for p0, (c, a, m0) in state.items() for k in range(3)
                for p, m in [chain(p0, m0, k)]]

    def chain(p, m, k):
        for _ in range(k):
            p = need[p]
            m = (*m, f"{name[p]}:")
        return p, m

    for role, text, fault in rows:
        new = {}
        for p, c, a, m in variants(state):
            options = [(p, c + 4, a + "D", m)]
            if fault not in ("blank", "duplicate"):
                add = 3 * (fault == "truncated")
                if role[:1] == "s" and p == "":
                    options.append(("s", c + add, a + "K", (*m, f"{role}:{text}")))
                if role[:1] == need[p]:
                    options.append((need[p], c + add, a + "K", (*m, f"{role}:{text}")))
                options.append((need[p], c + 3 + add, a + "R", (*m, f"{name[need[p]]}:{text}")))
            for q, *rest in options:
                new[q] = min(new.get(q, (9 ** 9,)), tuple(rest))
        state = new
    return min((c, a, list(m)) for p, c, a, m in variants(state) if p in ("", "a"))


def repair_brute(rows, solve):
    by = defaultdict(list)
    for n, (conv, turn, role, text) in enumerate(rows):
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv, its in by.items():
        its.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, marked, count = set(), [], Counter()
        for _, role, text in its:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = ("blank" if not bare else "duplicate" if (role, text) in seen
                     else "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
            count[fault] += 1
            marked.append((role, text, fault))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        turns = [t for t, _, _ in its if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, said = solve(marked)
        out.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit,
                    hashlib.sha256("\n".join(said).encode()).hexdigest()))
    return sorted(out, key=repr)


def random_codes(rng, n):
    return [(rng.choice(["system", "user", "assistant", "tool", ""]), "t", rng.choice([None, None, "blank", "truncated"]))
            for _ in range(n)]


def repaired(rows):
    from ampere.llm.conversation_repair import CODES, EDITS, END, START, TABLES, audit_of, crossings, forward, messages
    codes = [CODES[r[:1] if r[:1] in ("s", "u", "a") else "", "delete" if f in ("blank", "duplicate") else f or ""]
             for r, _, f in rows]
    at = crossings([TABLES[k] for k in (*codes, END)], START, START)
    audit = audit_of(codes, START, at[-2]) + EDITS[END][at[-2]][START]
    cost = forward([TABLES[k] for k in (*codes, END)], 0, len(codes) + 1, START)[0][START]
    return cost, audit, list(messages(audit, [(r, t) for r, t, _ in rows], START))


def test_repair_equals_every_sequence_of_edits():
    rng = random.Random(1)
    for k in range(150):
        rows = random_codes(rng, k % 6)
        assert repaired(rows) == cheapest(rows) == dynamic(rows), rows


def test_repair_of_long_conversations():
    rng = random.Random(2)
    for n in (30, 200, 701):
        rows = random_codes(rng, n)
        assert repaired(rows) == dynamic(rows)


def test_segments_sum_up_like_their_rows():
    from ampere.llm.conversation_repair import CODES, TABLES, crossings, summary
    rng = random.Random(3)
    for _ in range(30):
        codes = [rng.randrange(len(CODES)) for _ in range(40)]
        for first, last in itertools.product(range(4), range(4)):
            tables = [TABLES[k] for k in codes]
            if summary(codes)[0][first][last] >= 1 << 59:
                continue
            whole = crossings(tables, first, last)
            cut = crossings([summary(codes[:13]), summary(codes[13:27]), summary(codes[27:])], first, last)
            assert [whole[0], whole[13], whole[27], whole[40]] == cut


CONV = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def odd_conversations(spark):
    rng = random.Random(4)
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi."), (1, None, "system", "S."),
            (1, None, "user", None), (2, 5, "user", ""), (2, 9, "assistant", " \x0b"), (3, 0, "", "x"), (4, 2, "system", "Only.")]
    rows += [(5, k // 2, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["A.", "B!", "c", "", "A."]))
             for k in range(60)]
    rows += [(6, k, "user", "Same words.") for k in range(40)]
    rows += [(c, 0, "user", "Go.") for c in range(100, 160)]  # some of them lose their only row
    rows += [(7, -3, "user", "long " * 200_000 + "."), (7, 8, "assistant", "äö \U0001F600?")]
    return with_clashes(spark.createDataFrame(rows, CONV)).repartition(3)


@pytest.mark.parametrize("which", ["table", "odd", "nothing"])
def test_conversations_equal_brute_force(spark, odd_conversations, which):
    from ampere.llm.conversation_repair import repair_conversations
    df = {"table": spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"), "odd": odd_conversations,
          "nothing": odd_conversations.filter("false")}[which]
    out = repair_conversations(df)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = sorted(map(tuple, out.collect()), key=repr)
    assert got == repair_brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()], dynamic)
    if which == "odd":
        assert any(r[7] == "" and r[6] == 0 for r in got)


def test_one_long_conversation_over_many_segments(spark, monkeypatch):
    from ampere.llm import conversation_repair as m
    monkeypatch.setattr(m, "SEGMENT_ROWS", 7)
    rng = random.Random(5)
    rows = [(1 if k % 3 else k % 11, rng.randrange(400), rng.choice(["user", "assistant", "system"]),
             rng.choice([f"Text {rng.randrange(60)}.", "cut", " "])) for k in range(900)]
    df = spark.createDataFrame(rows, CONV).repartition(5)
    got = sorted(map(tuple, m.repair_conversations(df).collect()), key=repr)
    assert got == repair_brute(rows, dynamic)


# --- 13 quality classifier ------------------------------------------------

def test_quality_held_out_accuracy(spark):
    from ampere.llm.queries import op13_quality_classifier
    sf = "/root/testdata/sf0.1"
    got = op13_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    held = got[got.held_out]
    assert ((held.predicted == held.quality).mean() > 0.96) and 0 <= got.score.min() and got.score.max() <= 1
    good, bad = held.score[held.quality == 1], held.score[held.quality == 0]
    assert (good.to_numpy()[:, None] > bad.to_numpy()[None]).mean() > 0.95
    assert abs(held.score.mean() - held.quality.mean()) < 0.03


def test_normal_equations_equal_one_fit(spark):
    from ampere.llm import quality_classifier as q
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, len(q.STATISTICS)))
    y = (x[:, 0] + x[:, 1] ** 2 > 1).astype(float)
    rows = spark.createDataFrame([(list(map(float, a)), float(b), int(k % 3)) for k, (a, b) in enumerate(zip(x, y))],
                                 "x array<double>, y double, fold int").repartition(40)
    c = q.Cosines(x.mean(0), x.std(0))
    sums = q.normal_equations(rows, c)
    assert len(sums) == 3 * len(q.WIDTHS)
    z = c.of(x, q.WIDTHS[1])
    total = sum(sums[1, f] for f in range(3))
    assert np.allclose(total[:-1, :-1], z.T @ z) and np.allclose(total[:-1, -1], z.T @ y)
    w = q.ridge(total, 1e-3)
    pen = np.diag([1e-9, *[0.3] * q.FEATURES])
    assert np.allclose(w, np.linalg.solve(z.T @ z + pen, z.T @ y), atol=1e-6)
    assert np.isclose(q.squared_error(total, w), ((z @ w - y) ** 2).sum())


def test_cosines_approximate_the_kernel():
    from ampere.llm import quality_classifier as q
    d = len(q.STATISTICS)
    x = np.random.default_rng(1).normal(size=(40, d))
    near = [np.mean([(c := q.Cosines(np.zeros(d), np.ones(d), s).of(x, 1.0))[0, 1:] @ c[k, 1:] for s in range(60)]) for k in range(40)]
    exact = np.exp(-((x - x[0]) ** 2).sum(1) / (2 * d))
    assert np.abs(np.array(near) - exact).max() < 0.05


def test_pooling_is_the_isotonic_fit():
    from ampere.llm.quality_classifier import pooled
    rng = random.Random(6)
    for _ in range(40):
        n = rng.randrange(1, 9)
        y, w = [rng.random() for _ in range(n)], [rng.randrange(1, 4) for _ in range(n)]
        fit = [m for _, m, a, z in pooled(w, y) for _ in range(int(a), int(z) + 1)]
        # least squares under order: the minimum over ends of the maximum over starts of weighted means
        mean = lambda a, z: sum(v * u for v, u in zip(y[a:z + 1], w[a:z + 1])) / sum(w[a:z + 1])
        exact = [max(min(mean(a, z) for z in range(k, n)) for a in range(k + 1)) for k in range(n)]
        assert np.allclose(fit, exact)


def test_quality_odd_rows(spark, odd_docs):
    from ampere.llm.quality_classifier import STATISTICS, classify_quality, statistics
    labels = spark.createDataFrame([(1, 1), (1, 0), (8, 1), (9, 0), (None, 1), (4, None), (3, 0)], "doc_id long, quality int")
    out = classify_quality(odd_docs, with_clashes(labels))
    rows = out.collect()
    assert out.columns == ["doc_id", "score"] and len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in classify_quality(odd_docs, labels.filter("false")).collect()} == {0.5}
    assert {r.score for r in classify_quality(odd_docs, labels.filter("quality = 1 and doc_id = 8")).collect()} == {1.0}
    assert classify_quality(odd_docs.filter("false"), labels).collect() == []
    for t in (None, "", " ", "a", "!!!", "\U0001F600"):
        assert len(statistics(t)) == len(STATISTICS) and np.isfinite(statistics(t)).all()


def test_html_single_shared_text_goes_beside_own_siblings(spark):
    from ampere.llm.html_extract import extract_main_text
    page = ("<html><body><div class=c1><p>Start</p><p>News</p></div><div class=c2><p>Story {0} first</p><p>Story {0} second</p></div>"
            "<div class=c3><p>All rights reserved</p><p>Read next: story {0}</p></div></body></html>")
    one = ("<html><body><div class=c2><p>Same notice</p></div></body></html>")
    data = [(k, "http://plain.example/x", page.format(k)) for k in range(200)]
    data += [(k, "http://plain.example/x", page.format(k - 200)) for k in range(200, 260)]   # copies count once
    data += [(k, "http://seven.example/x", page.format(k)) for k in range(300, 307)]   # too few pages to judge
    data += [(400, "http://plain.example/x", one), (401, "http://plain.example/x", None)]
    got = {r.page_id: r.text for r in extract_main_text(
        spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert len(got) == len(data)
    for k in range(200):
        assert got[k] == f"Story {k} first\n\nStory {k} second\n\nRead next: story {k}"
    assert got[250] == got[50]
    assert got[300].startswith("Start\n\nNews\n\nStory 300 first") and "All rights reserved" in got[300]
    assert got[400] == "Same notice" and got[401] == ""


def test_html_text_on_fewer_pages_than_the_share_stays(spark):
    from ampere.llm.html_extract import extract_main_text
    page = "<html><body><div class=c2><p>Story {0} first</p>{1}<p>Story {0} second</p></div></body></html>"
    data = [(k, "http://h.example/", page.format(k, "<p>A passage that many share</p>" if k % 5 else "")) for k in range(100)]
    got = {r.page_id: r.text for r in extract_main_text(
        spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert all(("A passage that many share" in got[k]) == bool(k % 5) for k in range(100))
