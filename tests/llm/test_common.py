import gc

import public_tokenizers
from pyspark.sql import functions as F

from earshot.llm import langid, tokenstore
from earshot.llm.common import with_results
from tests.llm.tables import PROSE


def held(texts):
    """Scorers and encoders in this worker."""
    gc.collect()
    kinds = ("Scorer", "Encoder")
    return [[sum(type(o).__name__ in kinds and type(o).__module__.startswith("earshot.") for o in gc.get_objects())]
            * len(texts)]


def test_a_worker_drops_what_it_kept_for_an_earlier_stage(spark):
    """Workers are used again; a model or a memo of the stage before must not stay beside those of the next."""
    docs = spark.range(0, 64, 1, 32).select(F.lit(PROSE).alias("text"), F.lit("en").alias("lang"))
    look = docs.select("text")

    def most():
        return with_results(look, "text", "n int", lambda texts: held(texts), []).agg(F.max("n")).first()[0]

    model = langid.fit(docs)
    assert langid.predict(docs, model).filter("lang_pred = 'en'").count() == 64
    assert most() == 0
    counted = tokenstore.with_token_count(docs, public_tokenizers.path("byte_bpe_50k.json"))
    assert counted.agg(F.min("n_tokens")).first()[0] > 20
    assert most() == 0
