from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from dormouse.llm import bytebpe, queries
from dormouse.llm.bytetext import Texts
from tests.llm.plain import odd_rows, table

PATH = public_tokenizers.path(queries.RANK_FILE)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(count):
    choose = random.Random(2)
    parts = ["'", "s", "t", "re", "ll", "ve", "m", "d", " ", "  ", "\n", "\t", "a", "é", "漢", "7", "٣", "!", "''",
             " ", "　", "😀", "X", "\r\n", "_", "\x00", "́", "'S", "'r", "'l", "<|endoftext|>"]
    return ["".join(choose.choices(parts, k=choose.randint(0, 30))) for _ in range(count)]


def test_ids_equal_the_librarys_and_decode_to_the_text(library):
    rows = random_texts(3000) + [t or "" for _, t in odd_rows()] + [" " * 300, "'" * 300, "é" * 400, "ab" * 300]
    encoder = bytebpe.encoder(bytebpe.rank_file(PATH))
    for _ in range(2):  # the second time from the cache
        ids, counts = encoder.encode(Texts.of(pa.array(rows)))
        bounds = np.concatenate(([0], np.cumsum(counts)))
        data, ends = encoder.decode(ids, counts)
        for i, text in enumerate(rows):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == library.encode_ordinary(text), repr(text[:60])
            assert data[ends[i] : ends[i + 1]].tobytes() == text.encode()


def test_cache_is_bounded_and_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bytebpe, "CACHED_PIECES", 50)
    encoder = bytebpe.Encoder(bytebpe.Ranks(bytebpe.rank_file(PATH)))
    for text in random_texts(200):
        ids, _ = encoder.encode(Texts.of(pa.array([text])))
        assert ids.tolist() == library.encode_ordinary(text)
        assert len(encoder.keys) <= 100


def test_scan_of_functions_equals_running_the_automaton():
    of_symbol, composed, values, _ = bytebpe._functions()
    symbols = np.random.default_rng(3).integers(0, 9, 10_000)
    prefixes = bytebpe._prefixes(of_symbol[symbols], composed)
    state = bytebpe.FRESH
    for i, symbol in enumerate(symbols[:9000]):
        state = bytebpe._step(state, int(symbol))[0]
        assert values[prefixes[i], bytebpe.FRESH] == state


def test_encoded_and_decoded_tables(spark, tmp_path, library):
    docs = table(spark, tmp_path, odd_rows(), files=3, extra=True)
    rows = bytebpe.encoded(docs, "text", PATH)
    assert rows.columns == [*docs.columns, "ids", "id_bytes"]
    both = bytebpe.encoded(docs, "text", PATH, back="same")
    assert both.where("same <> coalesce(text, '')").count() == 0 and both.count() == rows.count()
    back = bytebpe.decoded(rows.withColumnRenamed("text", "before"), "ids", PATH)
    found = back.collect()
    assert len(found) == len(odd_rows())
    for row in found:
        assert row.text == (row.before or "") and row.ids == library.encode_ordinary(row.before or "")
        flat = (row.before or "").encode()
        for begin, end, number in zip(row.id_bytes, [*row.id_bytes[1:], len(flat)], row.ids):
            assert flat[begin:end] == library.decode_single_token_bytes(number)


def test_digests_and_empty_table(spark, tmp_path, library):
    docs = table(spark, tmp_path, odd_rows())
    wanted = []
    for key, text in odd_rows():
        ids = library.encode_ordinary(text or "")
        wanted.append((key, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                       hashlib.sha256((text or "").encode()).hexdigest()))
    found = [tuple(r) for r in bytebpe.digests(docs, "doc_id", "text", PATH).collect()]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert bytebpe.encoded(docs.where("false"), "text", PATH).count() == 0
