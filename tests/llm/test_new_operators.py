"""Importance resampling, token alignment and personal data against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.llm import importance, pii, queries, token_alignment
from tabforge.llm.tokens import byte_level_encoder
from tools.check import compare

WORDS = "alpha beta gamma delta omega sigma kappa lambda theta iota".split()


@pytest.fixture
def docs(spark):
    """Documents from texts, with columns whose names an operator might use itself."""
    def build(texts, ids=None):
        rows = list(zip(ids or range(len(texts)), texts))
        return spark.createDataFrame(rows, "doc_id long, text string").withColumns({
            c: F.lit(None).cast("string") for c in (
                "row", "lines", "at", "rank", "buckets", "spans", "score", "block", "bucket")})
    return build


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n))


# ---- 11 importance resampling --------------------------------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features_of(text):
    words = re.findall(importance.WORD, (text or "").translate(LOWER))
    runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return words, [zlib.crc32(r.encode()) % 10_000 for r in runs]


def draw(texts, ids, target, share=5):
    found = [features_of(t) for t in texts]
    s, t = Counter(b for _, f in found for b in f), Counter(
        b for x in target for b in features_of(x)[1])
    all_s, all_t = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
            for b in range(10_000)]
    rows = []
    for i, (words, f) in zip(ids, found):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append([i, len(f), weight, weight + noise, None, len(words)])
    able = sorted((r for r in rows if r[5] >= 20),
                  key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for place, r in enumerate(able[:share * len(able) // 100], 1):
        r[4] = place
    return sorted([tuple(r[:5]) for r in rows], key=str)


def test_windows_have_the_crc_of_their_text():
    texts = ["é " + "abc" * 500 + " x--" + "9" * 70, "", "one", "two  three four five", "\x00 ."]
    table = importance.WordTable()
    for _ in range(2):  # the second time all chunks are known
        words, counts = table.numbered([t.encode() for t in texts])
        found, owners = importance.window_buckets(words, counts, table, 3, 10_000)
        for i, t in enumerate(texts):
            assert sorted(found[owners == i].tolist()) == sorted(features_of(t)[1])
            assert counts[i] == len(features_of(t)[0])


def test_words_are_those_of_the_pattern():
    rng = random.Random(1)
    signs = "aZ09 .,-_\n\té漢🙂  /:@[`{\x7f\x80"
    for _ in range(200):
        text = "".join(rng.choice(signs) for _ in range(40))
        want = [(m.group(), m.span()) for m in re.finditer(importance.WORD, text.translate(LOWER))]
        assert importance.words_of(text) == want


@pytest.mark.parametrize("share", [5, 50])
def test_resampling(spark, docs, share):
    rng = random.Random(4)
    texts = [prose(rng, rng.choice([3, 19, 20, 40, 90])) for _ in range(120)]
    texts += [None, "", "... !", texts[5], texts[5], "A  B\tc " * 30, "é" * 5000 + " x" * 25]
    ids = list(range(100, 100 + len(texts) - 2)) + [None, 7]
    ids[-4] = ids[-5]
    texts[-4] = texts[-5] = prose(rng, 50)  # a repeated row
    target = [prose(rng, 30), None, "alpha1 beta2 gamma3 " * 9]
    got = importance.resample(
        docs(texts, ids), spark.createDataFrame([(t,) for t in target], "text string"), share=share)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    rows = sorted([tuple(r) for r in got.collect()], key=str)
    want = draw(texts, ids, target, share)
    # Which of two equal rows has the smaller rank is open.
    assert rows == want


def test_resampling_of_nothing(spark, docs):
    target = spark.createDataFrame([("a b",)], "text string")
    assert importance.resample(docs([]), target).count() == 0
    alone = importance.resample(docs(["a b c", None]), target.limit(0)).collect()
    assert {r["rank"] for r in alone} == {None} and {r["weight"] for r in alone if not r.n_features} == {0}


# ---- 12 token alignment --------------------------------------------------------------------


def spelled(text):
    a = token_alignment.byte_level_tokens(queries.BYTE_BPE)
    b = token_alignment.piece_tokens(queries.PIECE_BPE)
    if not text:
        return [], [], a, b
    ids_a, ids_b = a.encode(text), b.encode(text)
    whole = b" " + text.encode()
    if not (a.spell(np.array(ids_a), whole) and b.spell(np.array(ids_b), whole)):
        return [], [], a, b
    return ids_a, ids_b, a, b


def groups_by_ends(text):
    ids_a, ids_b, a, b = spelled(text)
    ends_a, ends_b = np.cumsum(a.size[ids_a]).tolist(), np.cumsum(b.size[ids_b]).tolist()
    out, before = [], 0
    for end in sorted(set(ends_a) & set(ends_b)):
        out.append(([i for i, e in zip(ids_a, ends_a) if before < e <= end],
                    [i for i, e in zip(ids_b, ends_b) if before < e <= end]))
        before = end
    return ids_a, ids_b, out


def test_token_bytes_and_plain_special_strings():
    ids_a, ids_b, a, b = spelled("x <|endoftext|> é漢 </s> <s>")
    assert ids_a and 50256 not in ids_a and not {0, 1, 2} & set(ids_b)
    assert b.spell(np.array(ids_b), " x <|endoftext|> é漢 </s> <s>".encode())
    assert not a.spell(np.array(ids_a[:-1]), " x <|endoftext|> é漢 </s> <s>".encode())


def test_alignment(docs):
    rng = random.Random(9)
    texts = [prose(rng, rng.choice([1, 5, 60])) for _ in range(40)]
    texts += [None, "", " ", "  a   b\n\n\tc ", "x <|endoftext|> </s>", "é漢字🙂 naïve", "ｆｕｌｌ ﬁ",
              "a▁b", "unbelievable" * 200, texts[3], "  　x", "\x00\x01"]
    ids = [*range(len(texts) - 1), None]
    found = [groups_by_ends(t) for t in texts]
    links = [Counter((x, y) for ga, gb in g for x in ga for y in gb) for _, _, g in found]
    count = Counter(pair for held in links for pair in held)
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    got = {r.doc_id: r for r in token_alignment.token_links(
        docs(texts, ids), queries.BYTE_BPE, queries.PIECE_BPE).collect()}
    assert len(got) == len(texts)
    for i, (ids_a, ids_b, groups), held in zip(ids, found, links):
        shown = ";".join(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}" for ga, gb in groups)
        assert tuple(got[i]) == (
            i, len(ids_a), len(ids_b), len(groups), sum(held.values()),
            sum(n for pair, n in held.items() if count[pair] == best[pair[0]]),
            sum(n * count[pair] for pair, n in held.items()),
            hashlib.sha256(shown.encode()).hexdigest() if groups else "")


def test_a_full_window_table_changes_nothing(monkeypatch):
    rng = random.Random(3)
    texts = [prose(rng, 30) for _ in range(20)]
    sides = (token_alignment.byte_level_tokens(queries.BYTE_BPE),
             token_alignment.piece_tokens(queries.PIECE_BPE))
    whole = token_alignment.Aligner(*sides).block(list(range(20)), texts)
    monkeypatch.setattr(token_alignment, "MEMO_WINDOWS", 10)
    small = token_alignment.Aligner(*sides)
    rows = [r for i in range(0, 20, 5) for r in small.block(list(range(i, i + 5)), texts[i:i + 5])["docs"]]
    for a, b in zip(rows, whole["docs"]):
        assert {k: a[k] for k in ("doc_id", "n_groups", "groups_sha256")} == {
            k: b[k] for k in ("doc_id", "n_groups", "groups_sha256")}


def test_alignment_of_nothing(docs):
    assert token_alignment.token_links(docs([]), queries.BYTE_BPE, queries.PIECE_BPE).count() == 0


# ---- 13 personal data ----------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(number))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            n = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "card": 13 <= len(n) <= 19 and luhn(n), "phone": 9 <= len(n) <= 15,
                    "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split("."))}[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def check_base(texts, ids, rows):
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts)
    for i, text in zip(ids, texts):
        want = base_spans(text)
        shown = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        r = got[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(
            sum(k == kind for k, _, _ in want) for kind in BASE), text
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest(), text
        assert r.spans == shown or r.spans.startswith(shown + ",term") or (
            not want and r.spans == "")


def test_base_spans(docs):
    rng = random.Random(8)
    texts = [None, "", "a@b.c_d@e.f", "x.y@z.co.uk. 🙂 q@r", "@a.b a@b c@d.e@f.g", "é1@x.y",
             "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.1.1.1111", "4111 1111 1111 1111",
             "4111-1111-1111-1111 4111  111111111111 41111111111111111111", "+1 (499) 555-6503, +1-2",
             "+12345678901234567 ++49 30 123456 +4", "4111 1111 1111 1111 12", "\n".join(
                 f"🙂 mail{i}@example.com tel +1 (20{i % 10}) 555-000{i % 10}" for i in range(700))]
    bits = ["a", "@", ".", "1", "22", "+", " ", "-", "(", "\n", "é", "b.c", "4111111111111111", "_"]
    texts += ["".join(rng.choice(bits) for _ in range(60)) for _ in range(400)]
    ids = [None, *range(len(texts) - 1)]
    check_base(texts, ids, pii.report(pii.spans_of(docs(texts, ids))).collect())


def test_long_runs_take_linear_time(docs):
    texts = ["x" * 400_000, "1" * 400_000, "a@" + "b." * 200_000, "+" * 100_000 + "1 " * 100_000,
             "1." * 300_000, "word " * 100_000 + "me@example.com", "9 " * 300_000]
    rows = pii.report(pii.spans_of(docs(texts))).collect()
    assert len(rows) == len(texts) and {r.doc_id: r.n_email for r in rows}[5] == 1


TELLING = [f"line {i} of quiet common words\nCall Waldemar at boss@corp.example now {i}" for i in range(6)]
PLAIN = [f"common words and line {i} of call at now" for i in range(200)]


def test_terms_that_disclose(docs):
    texts = TELLING + PLAIN + ["Waldemar is away"]
    out = {r.doc_id: r.spans for r in pii.spans_of(docs(texts)).collect()}
    for i, text in enumerate(texts):
        terms = {text[s.start:s.end] for s in out[i] if s.kind == 4}
        # Only near the entity, and not the words that occur everywhere.
        assert terms == ({"Waldemar"} if i < 6 else set())
    # By hand: on 7 of 213 lines, 6 of them with the entity, which has 6 lines itself.
    lines = pii.materialize(
        pii.document_lines(docs(texts)))
    told = {r.term: r for r in pii.disclosures(
        lines, pii.nearby_terms(lines), pii.term_lines(docs(texts)), generalise=0.0).collect()}
    n = 2 * 6 + 200 + 1
    assert told["waldemar"].ratio == pytest.approx(math.log(n / 7) / math.log(n / 6))
    assert told["waldemar"].action == "generalise"
    assert told["call"].ratio == pytest.approx(math.log(n / 206) / math.log(n / 6))


def test_terms_anywhere_in_the_text(docs):
    """Terms on another line or far away, against counts of all pairs in whole texts."""
    far = " ".join(["common"] * 60)
    texts = [f"Waldemar {i}\nboss@corp.example {i}\n{far} {i} Quist" for i in range(6)]
    texts += [f"common words {i} boss@other.example {i % 2} Ottilie" for i in range(4)]
    texts += [f"common words {i}" for i in range(200)] + ["Ottilie is away", None, ""]
    near = {r.doc_id: r.spans for r in pii.report(pii.spans_of(docs(texts))).collect()}
    assert near[3] == "email:11:28"
    out = {r.doc_id: r.spans for r in pii.spans_of(docs(texts), everywhere=True).collect()}
    sets = [set(re.findall(r"\w+", (t or "").lower())) for t in texts]
    n, n_term = len(texts), Counter(w for s in sets for w in s)
    for i, text in enumerate(texts):
        mail = re.search(r"boss@\S+", text or "")
        held = [s for t, s in zip(texts, sets) if mail and mail.group() in (t or "")]
        inside = re.findall(r"[^\W\d]+", re.sub(r"\S+@\S+", "", text or "")) if mail else []
        pairs = {w: sum(w.lower() in s for s in held) for w in inside}
        want = {w for w, k in pairs.items() if k > 1 and math.log(
            k * n / (len(held) * n_term[w.lower()])) >= 0.9 * math.log(n / len(held))}
        assert {text[s.start:s.end] for s in out[i] if s.kind == 4} == want, text
        assert sum(s.kind < 4 for s in out[i]) == bool(mail)
    assert {texts[3][s.start:s.end] for s in out[3] if s.kind == 4} == {"Waldemar", "Quist"}
    text = {r.doc_id: r.text for r in pii.sanitised(docs(texts), everywhere=True).collect()}[3]
    assert text == f" 3\n[email] 3\n{far} 3 "
    assert pii.spans_of(docs([]), everywhere=True).count() == 0


def test_query_looks_near_and_in_whole_texts(spark, docs, tmp_path):
    """Far terms of the query, which its SQL leaves out, and near ones that whole texts miss."""
    far = " ".join(["common"] * 60)
    texts = [f"Waldemar {i}\nboss@corp.example {i}\n{far} {i} Quist" for i in range(6)]
    texts += ["Ottilie 1 chef@corp.example\nOttilie 2 chef@corp.example"]
    texts += [f"common words {i}" for i in range(200)] + [None, ""]
    docs(texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in queries.QUERIES["op13_pii"](spark, str(tmp_path)).collect()}
    assert len(rows) == len(texts)
    near = {r.doc_id: r for r in pii.report(pii.spans_of(docs(texts))).collect()}
    end = len(texts[3])
    assert rows[3].spans == f"email:11:28,term:0:8,term:{end - 5}:{end}" and rows[3].n_term == 2
    assert near[3].n_term == 0 and rows[3].base_sha256 == near[3].base_sha256
    assert rows[6].spans == near[6].spans and rows[6].n_term == 2
    whole = {r.doc_id: r.spans for r in pii.spans_of(docs(texts), everywhere=True).collect()}
    assert all(s.kind < 4 for s in whole[6])
    assert all(rows[i].spans == "" for i in range(7, len(texts)))


def test_sanitised_text(docs):
    texts = TELLING + PLAIN + ["Waldemar is away", None, "", "no data", "1.2.3.4 and 1.2.3.4"]
    out = {r.doc_id: r.text for r in pii.sanitised(docs(texts)).collect()}
    assert out[2] == "line 2 of quiet common words\nCall [name] at [email] now 2"
    assert out[len(texts) - 1] == "[ip] and [ip]" and out[len(texts) - 2] == "no data"
    assert out[len(texts) - 3] == out[len(texts) - 4] == "" and out[10] == texts[10]
    # A word that occurs with the entity only gives it away as a whole.
    out = {r.doc_id: r.text for r in pii.sanitised(docs(TELLING + PLAIN)).collect()}
    assert out[2] == "line 2 of quiet common words\nCall  at [email] now 2"


def test_repeated_lines_are_no_support(docs):
    """The same line over and over says nothing about a term; different lines do."""
    texts = ["Waldemar boss@corp.example"] * 5 + PLAIN
    assert all(s.kind < 4 for r in pii.spans_of(docs(texts)).collect() for s in r.spans)


def test_personal_data_of_nothing(docs):
    assert pii.report(pii.spans_of(docs([]))).count() == 0
    assert pii.sanitised(docs([])).count() == 0


def test_personal_data_needs_no_python_worker(docs):
    plan = pii.spans_of(docs(TELLING))._jdf.queryExecution().executedPlan().toString()
    for bad in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "CartesianProduct"):
        assert bad not in plan


def test_personal_data_equals_sql(spark, docs):
    """Terms, contexts that are cut, and overlaps as in the SQL of the query."""
    rng = random.Random(6)
    names = ["Waldemar", "Ottilie", "Ärmel", "x1"]
    texts = TELLING + PLAIN + [None, ""]
    for i in range(60):
        name = rng.choice(names)
        texts.append(f"{prose(rng, rng.choice([0, 3, 60]))} {name} 10.0.{names.index(name)}.1 or "
                     f"+1 (222) 555-00{names.index(name)}0 {name}@corp.example {prose(rng, 40)}\n{i}")
    frame = docs(texts).select("doc_id", "text")
    con = duckdb.connect()
    con.register("documents", frame.toPandas())
    got = pii.report(pii.spans_of(frame)).toPandas()
    assert got.n_term.sum() > 20
    assert compare(got, con.execute(queries.ORACLES["op13_pii"]).df()).startswith("ok")


def test_long_blank_runs_have_the_ids_of_the_library():
    """As the tokenizers library encodes them; the other library's matcher gives up on them."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.BYTE_BPE)
    encode = byte_level_encoder(queries.BYTE_BPE)
    for text in ("a" + " " * 150_000 + "b c", "x\n" + "\n" * 120_000, "\t" * 110_000 + ".",
                 "a" + " \n" * 60_000 + "\nb" + " " * 100_000 + "<|endoftext|>"):
        assert encode(text) == library.encode(text, add_special_tokens=False).ids
    assert len(encode("a" + " " * 2_000_000 + "b")) > 2
