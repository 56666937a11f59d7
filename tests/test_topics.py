import pytest
from pyspark.sql import functions as F

from corpusmap import fixtures as fx
from corpusmap.operators import prompts
from corpusmap.plans.labelling import label_trees

NODES = "namespace string, node_id bigint, parent_id bigint, depth short, first_label string, final_label string"
NS = "enwiki_namespace_0"


def echo(system, prompt):
    assert "English" in system
    return f"  {len(prompt)}\n"


@pytest.fixture
def small(spark):
    """Root 1 with a lone stem 2 over stem 3 (leaves 4, 5) and the pageless leaf 6."""
    nodes = spark.createDataFrame(
        [(NS, 1, None, 0, None, None), (NS, 2, 1, 1, None, None), (NS, 3, 2, 2, None, None),
         (NS, 4, 3, 3, None, None), (NS, 5, 3, 3, None, None), (NS, 6, 2, 2, None, None)], NODES
    )
    pages = spark.createDataFrame(
        [(NS, 10, "Ten", "about  ten"), (NS, 11, "Eleven", None), (NS, 12, "Twelve", "")],
        "namespace string, page_id bigint, title string, abstract string",
    )
    vectors = spark.createDataFrame([(NS, 10, 4), (NS, 11, 4), (NS, 12, 5)], "namespace string, page_id bigint, cluster_node_id bigint")
    return nodes, pages, vectors, fx.languages(spark)


def labels(run):
    return {r["node_id"]: (r["first_label"], r["final_label"]) for r in run.nodes.collect()}


def test_retries():
    calls = []

    def failing(system, prompt):
        calls.append(len(prompt))
        raise prompts.ServerError(503)

    with pytest.raises(prompts.ServerError):
        prompts.call_labeler(failing, "s", "x" * 900, (0, 0))
    assert calls == [900, 450, 225, 225, 225]

    def bad_request(system, prompt):
        raise prompts.ServerError(400)

    with pytest.raises(prompts.ServerError):
        prompts.call_labeler(bad_request, "s", "x", (0, 0))
    assert prompts.call_labeler(lambda s, p: "  ", "s", "x") == ("", 0)
    assert prompts.call_labeler(lambda s, p: None, "s", "x") == (None, 0)


def test_refresh_resume_and_lone_child(small):
    run = label_trees(*small, echo, "refresh")
    got = labels(run)
    assert got[1] == ("English Wikipedia", "English Wikipedia")
    assert got[2][0] == got[2][1]  # no sibling
    assert got[6] == (None, None) or got[6][0] is None  # no pages
    assert all(got[i][0] and got[i][1] for i in (2, 3, 4, 5))
    assert run.processed == {NS: 3 + 3 + 2 + 2} and run.errors == 0
    again = label_trees(run.nodes, *small[1:], echo, "resume")
    assert labels(again) == got
    assert again.processed == {NS: 2}  # the leaf without pages is looked at in both leaf passes


@pytest.mark.parametrize("limit", [2, 4, 9])
def test_limit_counts_node_passes(small, limit):
    run = label_trees(*small, echo, "refresh", limit=limit)
    assert run.processed == {NS: limit}
    assert labels(run)[1] == (None, None)


def test_limit_not_reached_labels_the_root(small):
    assert labels(label_trees(*small, echo, "refresh", limit=11))[1][0] == "English Wikipedia"
    assert labels(label_trees(*small, echo, "refresh", limit=10))[1][0] is None


def test_strict_compat_skips_stems_that_have_a_first_label(small):
    nodes, *rest = small
    half = nodes.withColumn("first_label", F.when(F.col("node_id") == 3, "three"))
    assert labels(label_trees(half, *rest, echo, "resume"))[3][1] is not None
    assert labels(label_trees(half, *rest, echo, "resume", strict_compat=True))[3][1] is None


def test_prompt_text(small):
    nodes, pages, vectors, languages = small
    seen = {r["node_id"]: r["prompt"] for r in prompts.leaf_prompts(
        nodes.filter("node_id in (4, 5, 6)"), prompts_lines(pages, vectors)
    ).collect()}
    assert seen[4].endswith("The pages are: Ten: about ten; Eleven.")
    assert seen[5].endswith("The pages are: Twelve.") and seen[6] is None
    assert prompts.keyword_labeler("s", "x The pages are: alpha beta alpha.") == "Alpha beta"


def prompts_lines(pages, vectors):
    from corpusmap.operators.joins import node_page_lines

    return node_page_lines(pages, vectors)


def test_arguments(small):
    with pytest.raises(ValueError):
        label_trees(*small, echo, "again")
    with pytest.raises(ValueError):
        label_trees(*small, echo, "refresh", limit=0)


def test_calls_bound_the_tasks_that_call(spark):
    asked = spark.range(60, numPartitions=12).select(F.lit(NS).alias("namespace"), F.col("id").alias("node_id"), F.lit("p").alias("prompt"))
    systems = spark.createDataFrame([(NS, "s")], "namespace string, system_prompt string")
    found = prompts.label_prompts(asked, systems, lambda system, prompt: "label", calls=3)
    assert found.select(F.spark_partition_id().alias("task")).distinct().count() <= 3 and found.count() == 60


def test_a_prompt_that_no_attempt_answers_leaves_the_others_labelled(spark, small):
    def narrow(system, prompt):
        if "Ten" in prompt:
            raise prompts.ServerError(500, "too long")
        return "fine"

    run = label_trees(*small, narrow, "refresh", pause=(0, 0))
    got = labels(run)
    assert got[4] == (None, None) and got[5] == ("fine", "fine") and got[3] == ("fine", "fine")
    assert run.failed == 2 and run.errors == 2 * prompts.ATTEMPTS
    again = label_trees(run.nodes, *small[1:], lambda system, prompt: "later", "resume", pause=(0, 0))
    assert labels(again)[4] == ("later", "later") and labels(again)[5] == ("fine", "fine") and again.failed == 0


def test_a_refused_prompt_ends_the_job(small):
    def refuse(system, prompt):
        raise prompts.ServerError(400)

    with pytest.raises(Exception, match="server error 400"):
        label_trees(*small, refuse, "refresh", pause=(0, 0))
