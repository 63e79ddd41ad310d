import pytest


@pytest.fixture(autouse=True)
def checkpoints(spark, tmp_path_factory):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


@pytest.fixture(scope="session")
def hard_texts():
    """Null, empty, blank, odd blanks, ties, repeats, other scripts and one long text."""
    return [
        None, "", " ", "  a  b ", "a\n\nb \n c", "aaaa'sfoo  bar's\t\t　 \xa0 z", "日本語 テスト 😀 é", "\x1c a\x1c", "\x85 x",
        "The cat sat on the mat", "the cat sat on the mat", "The  cat sat on the\tmat", "x" * 3000, "ab" * 2000,
        "one two three four five six seven eight nine " * 3, "w" * 50 + " " + "long text of words " * 4000,
    ]


@pytest.fixture
def hard_docs(spark, hard_texts):
    """Extra columns carry names that operators use inside; ids are null and repeated too."""
    rows = [(i if i != 5 else None, t, "x", 1, 0.5) for i, t in enumerate(hard_texts)] + [(9, hard_texts[9], "x", 1, 0.5)] * 2
    return spark.createDataFrame(rows, "doc_id bigint, text string, score string, _hash int, row_number double")
