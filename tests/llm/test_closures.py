"""What operators send to the executors stays small."""

import public_tokenizers
import pyarrow as pa
from pyspark import cloudpickle

from fileload.llm import pieces, text, toxicity


def test_caches_of_the_driver_do_not_travel():
    toxicity._word_hashes(toxicity.SECOND_PERSON)
    text.Words(pa.array(["some words"])).hashes()
    pieces.model(public_tokenizers.path("piece_bpe_32k.model"))
    assert text.process_cache("pieces")
    for made in (text.Words, text.range_hash, toxicity.features, pieces.model, pieces.encode_decode):
        assert len(cloudpickle.dumps(made)) < 1 << 20


def test_models_load_once_in_a_process():
    path = public_tokenizers.path("piece_bpe_32k.model")
    again = cloudpickle.loads(cloudpickle.dumps(pieces.model))
    assert again(path) is again(path)
