from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fuelsight.llm import alignment as L

SF = "/root/testdata/sf0.001"
A = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def byte_alphabet():
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {chr(b): b for b in keep} | {chr(256 + k): b for k, b in enumerate(rest)}


ALPHABET = byte_alphabet()


def plain_tokens(text):
    """Token ids and bytes of both tokenizers, by their own files."""
    if not text:
        return [], []
    a = [(i, bytes(ALPHABET[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in B.encode(text):
        p = B.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode()))
    want = (" " + text).encode()
    if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
        return [], []
    return a, b


def spans(tokens):
    out, at = [], 0
    for _, x in tokens:
        out.append((at, at + len(x)))
        at += len(x)
    return out


def plain_alignment(text):
    a, b = plain_tokens(text)
    sa, sb = spans(a), spans(b)
    links = [(i, j) for i, (s, e) in enumerate(sa) for j, (t, f) in enumerate(sb) if s < f and t < e]
    cuts = sorted({e for _, e in sa} & {e for _, e in sb})
    groups, low = [], 0
    for c in cuts:
        groups.append((",".join(str(a[i][0]) for i, x in enumerate(sa) if low < x[1] <= c), ",".join(str(b[j][0]) for j, x in enumerate(sb) if low < x[1] <= c)))
        low = c
    return a, b, links, cuts, ";".join("|".join(g) for g in groups)


def plain_rows(docs):
    found = [(i, *plain_alignment(t)) for i, t in docs]
    count = Counter((a[x][0], b[y][0]) for _, a, b, links, _, _ in found for x, y in links)
    highest = {}
    for (_, y), n in count.items():
        highest[y] = max(highest.get(y, 0), n)
    rows = []
    for i, a, b, links, cuts, groups in found:
        ids = [(a[x][0], b[y][0]) for x, y in links]
        rows.append((i, len(a), len(b), len(cuts), len(links), sum(count[p] == highest[p[1]] for p in ids), sum(count[p] for p in ids),
                     hashlib.sha256(groups.encode()).hexdigest() if a else ""))
    return rows


def key(row):
    return (row[0] is None, row[0] or 0, *row[1:])


def test_same_ids_as_the_other_form_of_the_vocabulary(spark):
    tok = L.tokenizers(L._files())
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect() if r.text]
    texts += ["".join(f"a{chr(c)}1{chr(c)} {chr(c)}{chr(c)}\n" for c in range(lo, lo + 64)) for lo in [*range(0, 0x3000, 64), *range(0xFB00, 0xFFC0, 64), 0x1F600]]
    for t in texts:
        assert tok.a.encode_ordinary(" " + t) == A.encode(" " + t, add_special_tokens=False).ids
    assert [tok.a_bytes[i] for i in range(256)] == [bytes(ALPHABET[c] for c in A.id_to_token(i)) for i in range(256)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab theing  é漢▁😀<s>\n\r1,", max_size=60), max_size=4), st.sampled_from([1, 3, 256]))
def test_lockstep_equals_overlap(texts, lane):
    x = object.__new__(L.Aligned)
    before, L.LANE = L.LANE, lane
    try:
        x.__init__([t.encode() for t in texts], L.tokenizers(L._files()))
    finally:
        L.LANE = before
    written = list(x.groups())
    links = list(zip(x.link_a.tolist(), x.link_b.tolist(), strict=True))
    assert len(links) == len(set(links))
    for k, t in enumerate(texts):
        a, b, want, cuts, groups = plain_alignment(t)
        assert (x.n_a[k], x.n_b[k], x.n_links[k], x.n_groups[k]) == (len(a), len(b), len(want), len(cuts))
        own = sorted((i - x.first_a[k], j - x.first_b[k]) for i, j in links if x.first_a[k] <= i < x.first_a[k + 1])
        assert own == want and written[k].decode() == groups


def test_long_texts_are_cut_where_nothing_merges():
    tok = L.tokenizers(L._files())
    assert tok.parted
    rng = random.Random(5)
    text = "".join(rng.choice(["the ", "a", "Ing", "  ", "é ", "x1 ", ", ", "\n"]) for _ in range(60_000)).encode()
    before, L._PART = L._PART, 5_000
    try:
        assert len(tok.parts(text)) > 5 and " ".join(tok.parts(text)).encode() == text
        a, _, b, _ = tok.encode([text])
    finally:
        L._PART = before
    whole = text.decode()
    assert a.tolist() == A.encode(" " + whole, add_special_tokens=False).ids and b.tolist() == B.encode(whole)


def test_edge_cases(spark):
    rng = random.Random(1)
    words = ["the", "ing", "Wörter", "漢字", "<|endoftext|>", "</s>", "  ", "1234", "▁", "tab\t", "a\r\nb", "\0"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 12)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "a"), (103, "▁"), (None, "null id"), (7, docs[7][1]), (104, "same " * 50), (104, "same " * 50)]
    d = spark.createDataFrame([(i, t, 5, "z") for i, t in docs], "doc_id long, text string, chunk int, pair string").repartition(3)
    got = sorted((tuple(r) for r in L.alignment_counts(d).collect()), key=key)
    assert got == sorted(plain_rows(docs), key=key)
    assert L.alignment_counts(d.limit(0)).count() == 0
    assert [tuple(r)[1:] for r in L.alignment_counts(d.where("doc_id IN (100, 101)")).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_hostile_long_texts():
    for text in (b" " * 2_000_000, b"a" * 1_000_000, b"ab " * 500_000, "é".encode() * 300_000):
        x = L.Aligned([text], L.tokenizers(L._files()))
        assert x.n_a[0] and np.array_equal(np.sort(np.unique(x.link_a)), np.arange(x.n_a[0])) and len(np.unique(x.link_b)) == x.n_b[0]


def test_outputs_of_align(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 600").limit(40)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in L.align(docs).collect():
        a, b, links, cuts, _ = plain_alignment(texts[r.doc_id])
        assert r.a_ids == [i for i, _ in a] and r.b_ids == [i for i, _ in b]
        assert list(zip(r.link_a, r.link_b, strict=True)) == links
        ends = [e for _, e in spans(a)]
        assert [ends[i] for i in r.cut_a] == cuts and [spans(b)[j][1] for j in r.cut_b] == cuts


def test_query_on_the_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = L.op11_tokenizer_alignment(spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(fast_rows(docs))


def fast_rows(docs):
    """As :func:`plain_rows`, with links from a walk over the byte ends (whole texts are too long for all pairs)."""
    found, count, highest = [], Counter(), {}
    for i, text in docs:
        a, b = plain_tokens(text)
        sa, sb = spans(a), spans(b)
        ends, links = {e for _, e in sa} & {e for _, e in sb}, []
        cover = {}
        for j, (s, e) in enumerate(sb):
            for at in range(s, e):
                cover[at] = j
        for x, (s, e) in enumerate(sa):
            links += [(a[x][0], b[j][0]) for j in sorted({cover[at] for at in range(s, e)})]
        parts, left, right, at = [], [], [], 0
        for e, side, token in sorted([(e, 0, a[k][0]) for k, (_, e) in enumerate(sa)] + [(e, 1, b[k][0]) for k, (_, e) in enumerate(sb)]):
            (right if side else left).append(str(token))
            if side and e in ends:
                parts.append(",".join(left) + "|" + ",".join(right))
                left, right = [], []
        found.append((i, len(a), len(b), len(ends), links, hashlib.sha256(";".join(parts).encode()).hexdigest() if a else ""))
        count.update(links)
    for (_, y), n in count.items():
        highest[y] = max(highest.get(y, 0), n)
    return [(i, na, nb, g, len(links), sum(count[p] == highest[p[1]] for p in links), sum(count[p] for p in links), h) for i, na, nb, g, links, h in found]
