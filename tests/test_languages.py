import pytest

from corpusmap.fixtures import languages
from corpusmap.operators.prompts import system_prompts
from corpusmap.sources.languages import LANGUAGES, LanguageDataError, namespace_index, read_language_csv, with_language

HEADER = "Language,ISO 639-1 Code,Namespace\n"


def write(tmp_path, text):
    path = tmp_path / "languages.csv"
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_load(spark, tmp_path):
    text = HEADER + "".join(f"{name}, {code} ,{ns}\n" for name, code, ns in LANGUAGES)
    rows = {tuple(r) for r in read_language_csv(spark, write(tmp_path, text)).select("language", "iso_code", "namespace").collect()}
    assert rows == set(LANGUAGES) and len(rows) == 14


def test_last_duplicate_counts(spark, tmp_path):
    path = write(tmp_path, HEADER + "German,de,old\nGerman,de,new\n")
    assert [r["namespace"] for r in read_language_csv(spark, path).collect()] == ["new"]


def test_missing_file(spark):
    with pytest.raises(FileNotFoundError):
        read_language_csv(spark, "no_such_languages.csv")


@pytest.mark.parametrize("text", [
    "Invalid,CSV,Format\nToo,Few,Columns\n",
    "Chinese,zh,zhwiki_namespace_0\n",
    HEADER + "Chinese,zh,\nEnglish,,enwiki_namespace_0\n",
    HEADER,
])
def test_bad_files(spark, tmp_path, text):
    with pytest.raises(LanguageDataError):
        read_language_csv(spark, write(tmp_path, text))


def test_lookup(spark):
    index = {r["namespace"]: r["language"] for r in namespace_index(languages(spark)).collect()}
    assert index["enwiki_namespace_0"] == "English"
    assert index["frwiki_namespace_0"] == "French"
    assert index["dewiki_namespace_0"] == "German"
    assert index["arzwiki_namespace_0"] == "Egyptian Arabic"


def test_unknown_namespace(spark):
    df = spark.createDataFrame([("xx_namespace_0",)], "namespace string")
    with pytest.raises(Exception, match="no language for namespace xx_namespace_0"):
        with_language(df, languages(spark)).collect()
    assert with_language(df, languages(spark), strict=False).first()["language"] is None


def test_system_prompts_name_the_language(spark):
    wanted = {"dewiki_namespace_0": "German", "enwiki_namespace_0": "English", "arzwiki_namespace_0": "Egyptian Arabic"}
    df = spark.createDataFrame([(ns,) for ns in wanted], "namespace string")
    for row in system_prompts(df, languages(spark)).collect():
        assert row["system_prompt"].endswith(f"Generated output should only be in {wanted[row['namespace']]}.")
