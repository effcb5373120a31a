"""What the fitted and blocked operators hold on the driver, and pages of unusual markup."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestream.llm import dual_tree, html_crf, mil_quality

STORY = [
    "The old mill by the river was sold in spring, and the new owners moved in before the summer.",
    "They repaired the wheel first, because the water had to be led away from the walls of the house.",
    "By the end of the year the mill was grinding again, and the village had its own flour for the first time in decades.",
]


@pytest.fixture(scope="module")
def field(spark, sf):
    return html_crf.fit(spark.read.parquet(f"{sf}/pages.parquet"))


def test_article_in_a_plain_div(field):
    body = "".join(f"<p>{p}</p>" for p in STORY)
    page = f'<html><body><div class="menu"><a href="/">Home</a> <a href="/n">News</a></div><div>{body}</div></body></html>'
    assert html_crf.main_text(page, field) == "\n\n".join(STORY)


def test_article_in_a_table(field):
    body = "".join(f"<p>{p}</p>" for p in STORY)
    page = (
        '<html><body><table><tr><td class="menu"><a href="/">Home</a> <a href="/n">News</a> <a href="/c">Contact</a></td>'
        f"<td>{body}</td></tr></table></body></html>"
    )
    assert html_crf.main_text(page, field) == "\n\n".join(STORY)


def test_deep_markup_is_linear(field):
    began = time.monotonic()
    for open_tags in ("<div>word ", "<ul><li>word ", "<b>word<p>"):
        chain = html_crf.blocks(open_tags * 20_000)
        assert len(field.labels(chain)) == len(chain) >= 1
    assert time.monotonic() - began < 30


def test_shared_ancestors_give_the_scores_of_all_features(spark, sf, field):
    for row in spark.read.parquet(f"{sf}/pages.parquet").limit(25).collect():
        chain = html_crf.blocks(row["html"])
        assert field.labels(chain) == field.viterbi(html_crf.encode(chain))


def test_fit_without_articles_and_in_capitals(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    none = pages.withColumn("html", F.replace("html", F.lit("article"), F.lit("section")))
    body = "".join(f"<p>{p}</p>" for p in STORY)
    page = f'<html><body><nav><a href="/">Home</a></nav><article>{body}</article><footer>&copy; 2020</footer></body></html>'
    for table in (none, pages.limit(0)):
        assert html_crf.main_text(page, html_crf.fit(table)) == "\n\n".join(STORY)
    capitals = pages.withColumn("html", F.replace("html", F.lit("<article"), F.lit("<ARTICLE")))
    assert html_crf._least(capitals.select(F.xxhash64("html").alias("h")), 300).count() > 0
    assert np.abs(html_crf.fit(capitals, 20, 1).emit).sum() > 0


def test_fit_takes_a_repeated_page_once(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html")
    hot = pages.unionAll(pages.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("n"))
    assert (html_crf.fit(hot, 40, 1).emit == html_crf.fit(pages, 40, 1).emit).all()


def test_classifier_takes_a_repeated_id_once(spark, sf, documents):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    row = documents.join(labels, "doc_id").where(~mil_quality.held_out(F.col("doc_id"))).select("doc_id", "text").limit(1)
    copies = F.explode(F.sequence(F.lit(1), F.lit(2000)))
    docs = documents.select("doc_id", "text")
    hot = docs.unionAll(row.withColumn("n", copies).drop("n")).repartition(7)
    plain, again = mil_quality.fit(docs, labels), mil_quality.fit(hot, labels)
    assert all(np.array_equal(plain.weights[k], again.weights[k]) for k in plain.weights)
    # Other texts under the same id: one of them is taken.
    other = docs.unionAll(row.select("doc_id", copies.alias("n")).select("doc_id", F.concat(F.lit("x"), "n").alias("text")))
    assert mil_quality.fit(other, labels).weights.keys() == plain.weights.keys()


def test_top_k_of_several_query_blocks(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    asked = vectors.where("vec_id % 10 = 0")
    one = sorted(map(tuple, dual_tree.top_k(asked, vectors).collect()))
    several = dual_tree.top_k(asked, vectors, block=16)
    # Stored results only: no broadcast of a block is left in the plan.
    assert "MapInArrow" not in several._jdf.queryExecution().toString()
    assert sorted(map(tuple, several.collect())) == one
