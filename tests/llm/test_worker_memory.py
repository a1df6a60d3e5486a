"""What a Python worker and an Arrow batch hold at once."""

import numpy as np
import pyarrow as pa

from tabreg.llm import dartminhash, language_id, packing, suffix_tree_lm
from tabreg.llm.common import ARROW_BYTES, ship_package
from tabreg.llm.queries import tokenizer_path


def test_a_worker_remembers_the_words_of_one_operator():
    text = "alpha beta gamma delta epsilon zeta eta theta"
    packing.ByteBpeEncoder.of(tokenizer_path()).encode(text)
    dartminhash.elements([text])
    assert dartminhash._HASHES and not packing.ByteBpeEncoder._kept
    suffix_tree_lm.tokens([text])
    assert suffix_tree_lm._HASHES and not dartminhash._HASHES
    language_id._scored([text], np.zeros((3, 64**3), np.float32), False)
    assert not (packing.ByteBpeEncoder._kept or dartminhash._HASHES or suffix_tree_lm._HASHES)


def test_long_texts_cross_in_small_batches(spark):
    ship_package(spark)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([b.num_rows])], names=["size", "n"])

    long = spark.range(0, 4000, 1, 1).selectExpr("repeat('x', 10000) AS text")
    found = long.mapInArrow(sizes, "size long, n long").collect()
    assert sum(r["n"] for r in found) == 4000
    assert max(r["size"] for r in found) < 2 * ARROW_BYTES
