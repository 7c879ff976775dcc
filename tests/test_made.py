"""Pages made from the star tables."""


def test_made_pages_are_parsed_by_many_tasks(spark, small):
    """F16, F19, F20, F23: a small file of suppliers is one task no more."""
    from kgloom.plans import made

    assert made.pages(spark, small).rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
