import pytest
from pyspark.sql.types import StringType, StructType

# columns of documents, and names that the operators use themselves
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _words string, hash long, sid long, key long, "
          "_id long, _key string, _doc int, d string, c int, node long, component long, least string, text_key int, k_id int, k_text int, "
          "_tokens string, _source int, _lang int, _topic int, _prob string, _keep int, _row int, _draw string, row string, "
          "_hit_id int, _hit_key int, _hit_spans int, hit_id int, hit_key int, spans string, own_id int, own_key int, "
          "_part int, _p string, `a.b` string, y string, stem int, n int, u int")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, empty, letterless and very long texts, repeated rows,
    an id with two texts, and columns whose names the operators use."""
    long_text = " ".join(f"word{i % 977} thing{i % 13}," for i in range(20_000))
    same = "one two three four five six seven eight nine ten eleven"
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "  \n ", "en", "a"), (4, long_text, "en", "a"), (5, same, "en", None),
            (5, same, "en", None), (6, same + " twelve", "en", "b"), (6, "another text, said \"idiot\" <|endoftext|> x", "fr", "b"),
            (None, "no id here at all", "fr", "b"), (None, None, None, None), (7, "12345 --- 678", "de", "c"),
            (8, "Él niño\n\nß ﬁ 漢字  x", "es", "c"), (9, same, "en", "a")]
    fields = StructType.fromDDL(SCHEMA).fields[4:]
    more = ["w" if isinstance(f.dataType, StringType) else i for i, f in enumerate(fields)]
    return spark.createDataFrame([(*r, *more) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
