import os

import pytest
from conftest import rows

from sftframe.options import SftOptions
from sftframe.session import cut_lineage, shared_folder
from sftframe.sources import adapters
from sftframe.sources.cache import reuse, source_state
from sftframe.sources.tables import instruction_table, named_turn, preference_table, read_table, spread

ROWS = [(1, "Say \"hi\",\nplease", "hi", "train"), (2, "Count", "1, 2", "test")]
SCHEMA = "pair_id BIGINT, question STRING, output STRING, split STRING"
OPTS = SftOptions(instruction_col="question", response_col="output")


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc"])
def test_formats_and_split(spark, tmp_path, fmt):
    writer = spark.createDataFrame(ROWS, SCHEMA).write
    writer = writer.option("header", True).option("escape", '"') if fmt == "csv" else writer
    writer.format(fmt).save(str(tmp_path / "t"))
    whole = read_table(spark, str(tmp_path / "t"), fmt, SCHEMA, multi_line=True)
    assert sorted(rows(instruction_table(whole, OPTS))) == [r[:3] for r in ROWS]
    train = read_table(spark, str(tmp_path / "t"), fmt, SCHEMA, split="train", multi_line=True)
    assert [r[0] for r in rows(train)] == [1]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,response,instruction\n1,RESP,INST\n")
    made = read_table(spark, str(tmp_path / "t.csv"), "csv", "id BIGINT, instruction STRING, response STRING")
    assert rows(made) == [(1, "INST", "RESP")]
    (tmp_path / "bad.csv").write_text("id,response,instruction\nx,RESP,INST\n")
    with pytest.raises(Exception, match="BIGINT"):
        read_table(spark, str(tmp_path / "bad.csv"), "csv", "id BIGINT, instruction STRING").collect()


def test_unknown_format_and_missing_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="format"):
        read_table(spark, str(tmp_path), "xml")
    with pytest.raises(ValueError, match="response"):
        instruction_table(spark.createDataFrame([(1, "a")], "pair_id BIGINT, instruction STRING"), SftOptions())
    with pytest.raises(ValueError, match="prompt"):
        preference_table(spark.createDataFrame([(1, "a", "b")], "pair_id BIGINT, chosen STRING, rejected STRING"))


MESSAGES = "ARRAY<STRUCT<role: STRING, content: STRING>>"


def test_message_lists(spark):
    chat = [("user", "q1"), ("assistant", "a1"), ("user", "q2")]
    df = spark.createDataFrame(
        [(7, [*chat, ("assistant", "good")], [*chat, ("assistant", "bad")])],
        f"pair_id BIGINT, chosen {MESSAGES}, rejected {MESSAGES}",
    )
    assert rows(preference_table(df)) == [(7, "q1\n\na1\n\nq2", "good", "bad")]


def test_roles_unlike_prompts_and_empty_lists(spark):
    def made(chosen, rejected):
        return spark.createDataFrame([(1, chosen, rejected)], f"pair_id BIGINT, chosen {MESSAGES}, rejected {MESSAGES}")

    one, other = [("user", "q"), ("assistant", "a")], [("user", "z"), ("assistant", "b")]
    assert rows(preference_table(made(one, one), turn=named_turn)) == [(1, "user: q", "a", "a")]
    assert rows(preference_table(made([], []))) == [(1, "", None, None)]
    with pytest.raises(Exception, match="different prompts"):
        preference_table(made(one, other)).collect()


def test_replaced_file_of_equal_length_is_noticed(spark, tmp_path):
    source = tmp_path / "deep" / "source"
    source.mkdir(parents=True)
    (source / "a.csv").write_text("x\n1\n")
    before = source_state(spark, [str(tmp_path / "deep")])
    (source / "a.csv").write_text("x\n2\n")
    os.utime(source / "a.csv", (1, 1))
    assert source_state(spark, [str(tmp_path / "deep")]) != before


def test_own_prompt_wins(spark):
    df = spark.createDataFrame(
        [(7, "mine", [("user", "q"), ("assistant", "good")], [("user", "q"), ("assistant", "bad")])],
        f"pair_id BIGINT, prompt STRING, chosen {MESSAGES}, rejected {MESSAGES}",
    )
    assert rows(preference_table(df)) == [(7, "mine", "good", "bad")]


def test_pairs_of_a_conversation(spark):
    df = spark.createDataFrame(
        [(1, 0, "system", "s"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, 3, "user", "c"), (2, 0, "user", "d"), (2, 1, "user", "e"), (2, 2, "assistant", "f")],
        "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    )
    assert sorted(rows(adapters.conversation_pairs(df))) == [("1-1", "a", "b"), ("2-1", "e", "f")]


def test_long_conversations_keep_their_pairs_apart(spark):
    df = spark.range(0, 2002).selectExpr(
        "if(id < 2000, 0, 10000000000) as conv_id", "if(id < 2000, id, id - 2000) as turn",
        "if(id % 2 = 0, 'user', 'assistant') as role", "cast(id as string) as text",
    )
    made = adapters.conversation_pairs(df)
    assert made.count() == made.select("pair_id").distinct().count() == 1001


def test_pairs_of_documents(spark):
    df = spark.createDataFrame([(1, "first\nsecond\nthird"), (2, "one line"), (3, "\nx"), (4, "y\n")], "doc_id BIGINT, text STRING")
    assert sorted(rows(adapters.document_pairs(df))) == [(1, "first", "second\nthird"), (2, "one line", ""), (3, "", "x"), (4, "y", "")]


def test_preference_pairs_take_the_next_response(spark):
    df = spark.createDataFrame([(i, f"q{i}", f"a{i}") for i in range(20)], "pair_id BIGINT, instruction STRING, response STRING")
    made = adapters.preference_pairs(df).orderBy("p").collect()
    assert [r["p"] for r in made] == list(range(20))
    for row, after in zip(made, made[1:] + made[:1]):
        assert row["chosen"] == f"a{row['pair_id']}" and row["rejected"] == after["chosen"]


def test_table_is_made_once_per_state_of_its_source(spark, tmp_path):
    source, root = str(tmp_path / "source"), str(tmp_path / "prepared")
    spark.range(5).write.parquet(source)
    calls = []

    def build():
        calls.append(1)
        return spark.read.parquet(source)

    for _ in range(2):
        assert reuse(spark, "t", [source], {"a": 1}, build, root).count() == 5
    assert len(calls) == 1
    reuse(spark, "t", [source], {"a": 2}, build, root)
    assert len(calls) == 2
    spark.range(3).write.mode("append").parquet(source)
    assert reuse(spark, "t", [source], {"a": 1}, build, root).count() == 8
    assert len(calls) == 3


def test_half_written_table_is_not_read(spark, tmp_path):
    source, root = str(tmp_path / "source"), str(tmp_path / "prepared")
    spark.range(5).write.parquet(source)

    def failing():
        return spark.range(5).selectExpr("id", "if(id = 4, raise_error('lost'), 1) as x")

    with pytest.raises(Exception, match="lost"):
        reuse(spark, "t", [source], {}, failing, root)
    assert reuse(spark, "t", [source], {}, lambda: spark.read.parquet(source), root).columns == ["id"]


def test_shared_folder_is_the_cluster_s(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    assert cut_lineage(spark.range(3)).count() == 3


def test_spread_only_for_small_tables(spark):
    assert spread(spark.range(0, 10, 1, 1), "id").rdd.getNumPartitions() == 4
    wide = spark.range(0, 10, 1, 9)
    assert spread(wide, "id") is wide
