"""Reports read back from result tables, and the rows that feed the tables."""

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions.fixed_values import REPORT_CLUSTERS
from corpusloom.sources.result_tables import of_job


def keyword_lists(keywords: DataFrame) -> DataFrame:
    """(cluster_id, keywords, keyword_weights): parallel lists, heaviest first.

    At most 100 keywords per cluster.
    """
    entry = F.struct("rank", "term", "weight")
    lists = keywords.groupBy("cluster_id").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    return lists.select(
        "cluster_id", F.col("e.term").alias("keywords"), F.col("e.weight").alias("keyword_weights")
    )


def ordered_top_documents(top: DataFrame, largest: DataFrame) -> DataFrame:
    """(cluster_id, doc_order_id, doc_id, cos_sim, text) for the largest clusters.

    A cluster's documents are numbered from 0; there is one per cluster.
    """
    listed = (
        top.join(F.broadcast(largest.select("cluster_id")), "cluster_id")
        .groupBy("cluster_id")
        .agg(F.collect_list(F.struct("doc_id", "cos_sim", "text")).alias("docs"))
    )
    return listed.select("cluster_id", F.posexplode("docs").alias("doc_order_id", "d")).select(
        "cluster_id", "doc_order_id", "d.doc_id", "d.cos_sim", "d.text"
    )


def report_keywords(
    job_clusters: DataFrame, cluster_keywords: DataFrame, job_id: int, n: int = REPORT_CLUSTERS
) -> DataFrame:
    """Largest clusters of a job with label, size and keyword lists."""
    key = ["job_id", "cluster_id"]
    joined = of_job(job_clusters, job_id).join(of_job(cluster_keywords, job_id), key)
    return (
        joined.orderBy(F.desc("num_docs"), "cluster_id")
        .limit(n)
        .select("cluster_id", "cluster_label", "num_docs", "keywords", "keyword_weights")
    )


def report_topdocs(
    job_clusters: DataFrame, cluster_topdocs: DataFrame, job_id: int, n: int = REPORT_CLUSTERS
) -> DataFrame:
    """The top document of each of a job's largest clusters."""
    largest = (
        of_job(job_clusters, job_id)
        .orderBy(F.desc("num_docs"), "cluster_id")
        .limit(n)
        .select("job_id", "cluster_id", "num_docs")
    )
    first = of_job(cluster_topdocs, job_id).filter("doc_order_id = 0")
    return largest.join(first, ["job_id", "cluster_id"]).select(
        "cluster_id", "num_docs", "doc_order_id", "doc_id", "cos_sim", "text"
    )
