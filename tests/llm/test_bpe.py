import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from flowwarden.llm import bpe
from flowwarden.llm.common import ready, table

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check(df, library):
    want = []
    for r in df.select("doc_id", "text").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)), ids))
    digests = [tuple(r) for r in bpe.encode_digests(df, PATH).collect()]
    assert sorted(digests, key=str) == sorted((w[:4] for w in want), key=str)
    ids = [(r["doc_id"], r["n_tokens"], r["ids"]) for r in bpe.encode_texts(df, PATH).collect()]
    assert sorted(ids, key=str) == sorted(((w[0], w[1], w[4]) for w in want), key=str)
    back = bpe.decode_ids(bpe.encode_texts(df, PATH), PATH).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in back), key=str) == sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), key=str)


def test_documents(spark, sf, library):
    check(table(ready(spark), sf, "documents"), library)


def test_edges(edges, nothing, library):
    check(edges, library)
    assert bpe.encode_digests(nothing, PATH).collect() == []


def test_all_characters(library):
    own = bpe.Bpe(PATH)
    chars = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(chars), 1000):
        text = " ".join(chars[k : k + 1000]) + "".join(chars[k : k + 1000])
        (entries,) = own.encode([text])
        assert b",".join(e[1] for e in entries).decode() == ",".join(map(str, library.encode(text, add_special_tokens=False).ids))


def test_memory_of_words_does_not_change_results(monkeypatch, library):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    own = bpe.Bpe(PATH)
    for text in ("aaa aaaa bb aaaaa", "bb aaa the theme", "x" * 500 + " aaa"):
        (entries,) = own.encode([text])
        assert b",".join(e[1] for e in entries).decode() == ",".join(map(str, library.encode(text, add_special_tokens=False).ids))


def test_broken_sequences_decode_with_the_replacement_character(library):
    own = bpe.Bpe(PATH)
    ids = library.encode("🤷é", add_special_tokens=False).ids[:-1]
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)
