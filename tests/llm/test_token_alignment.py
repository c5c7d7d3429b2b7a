"""Token alignment against the libraries on whole texts, and counts against plain dictionaries."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aeroledger.llm import queries, token_alignment
from aeroledger.llm.token_alignment import byte_of_char, vocabularies

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain_groups(text, libraries):
    """Groups of the whole text as lists of ids, or [] without tokens."""
    a, b = libraries
    if not text:
        return []
    to_byte, data = byte_of_char(), (" " + text).encode()
    of_a, of_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    ends = []
    for tokens in (
        [bytes(to_byte[c] for c in a.id_to_token(i)) for i in of_a],
        [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in of_b],
    ):
        if b"".join(tokens) != data:
            return []
        at, own = 0, []
        for t in tokens:
            at += len(t)
            own.append(at)
        ends.append(own)
    groups, start = [], (0, 0)
    after = [{end: k + 1 for k, end in enumerate(own)} for own in ends]
    for cut in sorted(after[0].keys() & after[1].keys()):
        stop = after[0][cut], after[1][cut]
        groups.append((of_a[start[0] : stop[0]], of_b[start[1] : stop[1]]))
        start = stop
    return groups


def plain_rows(rows, libraries):
    found = [plain_groups(t, libraries) for _, t in rows]
    count = Counter((g[0][-1], g[1][-1]) for groups in found for g in groups)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for (i, _), groups in zip(rows, found, strict=True):
        links = [(g[0][-1], g[1][-1]) for g in groups]
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        n_best, total = sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append((i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links), n_best, total, digest))
    return sorted(out, key=repr)


def digest_of(groups):
    text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
    return len(groups), hashlib.sha256(text.encode()).hexdigest() if groups else ""


def document(tool, text):
    found = token_alignment.Document()
    for part in tool.align(list(tool.parts(text))) if text else ():
        found.add(part)
    return found.columns()


def sample(n):
    rng = random.Random(n)
    some = ["the", "Über", "don't", "x1y22", "日本", "\n", "\n\n", "  ", " ", "\t", "é", "<|endoftext|>", "<s>", "…", "naïve", "antidisestablishment", "a.b,c!", "🙂", "　", "\x1f", " ", "\xa0"]
    return ["".join(rng.choice([w, w, w + " "]) for w in rng.choices(some, k=rng.randrange(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("heavy_parts", [1 << 16, 1, 40])
def test_alignment_as_the_libraries(spark, libraries, heavy_parts):
    texts = sample(50) + ["", None, " ", "\n", "a▁b c", "\x00 a", "no end", " lead", "tail ", "a  b c  d"]
    rows = [*enumerate(texts), (3, "twice the"), (3, "twice the"), (None, "no id"), (900, "long words and " * 20_000 + "end")]
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], "doc_id long, text string, row string, pairs string")
    got = token_alignment.score_links(token_alignment.align(docs.repartition(4), A, B), A, B, heavy_parts=heavy_parts)
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_rows(rows, libraries)
    assert token_alignment.score_links(token_alignment.align(docs.limit(0), A, B), A, B).count() == 0


def test_alignment_of_a_table(spark, sf_dir, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op11_token_alignment(spark, sf_dir).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_rows(rows, libraries)


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t\r\x1c\x85\xa0 'sté1.▁"), st.characters(codec="utf-8")), max_size=40))
def test_parts_join_to_the_library_result(libraries, text):
    tool = vocabularies(A, B)
    assert tool.splits
    assert document(tool, text)[2:4] == digest_of(plain_groups(text, libraries))


def test_identity_map_and_long_texts(libraries, monkeypatch):
    tool = vocabularies(A, B)
    for a, b in enumerate(tool.same.tolist()):
        assert b < 0 or tool.a_bytes[a] == tool.b_bytes[b]
    assert (tool.same >= 0).sum() > 5_000 and len({b for b in tool.same.tolist() if b >= 0}) == (tool.same >= 0).sum()
    monkeypatch.setattr(token_alignment, "PART_CHARS", 5)
    monkeypatch.setattr(token_alignment, "REMEMBERED", 30)
    for text in sample(200):
        assert " ".join(tool.parts(text)) == text
        assert document(tool, text)[2:4] == digest_of(plain_groups(text, libraries))
