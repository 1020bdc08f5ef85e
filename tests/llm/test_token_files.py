import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import clashing, odd_documents
from tokenizers import Tokenizer

from tidebars.llm import token_files as t

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("top", [1, 200, 70_000, 1 << 24, 1 << 32])
def test_pack_and_unpack(top):
    rng = np.random.default_rng(top % 97)
    for n in (0, 1, 3, 4, 5, 1000, (1 << 17) + 3):
        values = rng.integers(0, top, n, dtype=np.uint64).astype("<u4")
        control, data = t.pack(values)
        assert len(control) == -(-n // 4)
        assert (t.unpack(control, data, n) == values).all()


def expected(docs, end_id=2):
    library = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + ([] if end_id is None else [end_id])
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("per_file", [t.IDS_PER_FILE, 50])
def test_files_hold_all_documents_in_order(spark, folder, per_file):
    texts = ["one two three", "four  five\n\n<|endoftext|>", "", "Ünïcode wörds 日本", " ".join(random.Random(4).choices(["alpha", "beta", "gam ma"], k=300))]
    docs = clashing(odd_documents(spark, texts), "start", "TIE", "copy").repartition(3)
    files = t.write_token_files(docs, f"{folder}/ids", PATH, end_id=2, per_file=per_file).collect()
    names = sorted(f.file for f in files)
    assert len(glob.glob(f"{folder}/ids/*.ids")) == len(names)
    assert [f.start for f in sorted(files, key=lambda f: f.file)] == sorted(f.start for f in files)
    back = t.read_token_files(spark, f"{folder}/ids").collect()
    got = sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in back), key=lambda r: r[1])
    assert got == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_no_documents(spark, folder):
    docs = odd_documents(spark, ["x"]).limit(0)
    assert t.write_token_files(docs, f"{folder}/ids", PATH, end_id=2).count() == 0
    assert t.read_token_files(spark, f"{folder}/ids").count() == 0


def test_usual_ids_take_one_byte(spark, folder):
    docs = odd_documents(spark, ["the of and " * 500])
    files = t.write_token_files(docs, f"{folder}/ids", PATH).collect()
    assert sum(f.n_bytes for f in files) < 1.5 * sum(f.n_ids for f in files) + 1000


def test_registered_query(spark, sf_dir):
    from tidebars.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op6_token_files"](spark, sf_dir).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == expected([(r.doc_id, r.text) for r in docs])
