"""The pluggable tokenizer count (Arrow UDF, tokenizer built once per worker)."""

import sys

from pyspark import cloudpickle

from chatsift.functions.text import token_count, tokenizer_count_udf

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def whitespace_tokenizer():
    from tokenizers import Tokenizer, models, pre_tokenizers

    tok = Tokenizer(models.WordLevel({"[UNK]": 0}, unk_token="[UNK]"))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    return tok


def test_tokenizer_udf_counts(spark):
    count = tokenizer_count_udf(whitespace_tokenizer)
    df = spark.createDataFrame([("Bonjour, le monde !",), ("a b c",), (None,)], "t string")
    got = [r.n for r in df.select(count("t").alias("n")).collect()]
    # Whitespace pre-tokenizer splits words and punctuation, like the default pre-token count.
    native = [r.n for r in df.select(token_count("t").alias("n")).collect()]
    assert got[:2] == [5, 3] and got[2] is None
    assert native[:2] == got[:2]
