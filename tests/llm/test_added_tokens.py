"""Ids of texts that hold an added token of the tokenizer file, against tokenizers itself."""

import random
import zlib

import numpy as np
import pyarrow as pa

from millrace.llm import packing
from millrace.llm.queries import tokenizer_path

END = "<|endoftext|>"


def test_added_tokens_have_their_own_ids(spark):
    from tokenizers import Tokenizer

    rng = random.Random(11)
    parts = [END, END, "<|endo", "ftext|>", " ", "  ", "\n", "\n\n", "one", "é", "'s", "7", "<|", "|>", "\t", " "]
    texts = ["one " + END + " two", END, END + END, "one <|endo", "ftext|> two", f"a  {END}\n b", None, "", ("word " * 700 + END) * 5]
    texts += ["".join(rng.choices(parts, k=rng.randrange(1, 12))) for _ in range(2000)]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert want[0] == [505, 220, 50256, 734]
    ids, sizes = packing.Encoder(tokenizer_path())(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want
    rows = packing.pack_documents(spark.createDataFrame(list(enumerate(texts[:9])), "doc_id long, text string"), tokenizer_path()).collect()
    for r in rows:
        here = (want[r["doc_id"]] + [0])[r["start"] : r["start"] + r["length"]]
        assert len(here) == r["length"] and r["ids_crc32"] == zlib.crc32(np.array(here, "<u4").tobytes())
    assert sum(r["length"] for r in rows) == sum(len(x) + 1 for x in want[:9])
