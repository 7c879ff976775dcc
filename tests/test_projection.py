"""How the projection of the test tables is dealt out."""


def test_projected_edges_lie_by_source(spark, small):
    """F8-F22: one exchange of numbers serves both the distinct edges and the join on src."""
    from kgloom.plans import project

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = project.edges(spark, small)
        plan = edges.groupBy("src").count()._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(concat(part-") == 1 and "Exchange hashpartitioning(src" not in plan
        assert edges.count() == edges.distinct().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_census_takes_sizes_of_texts_and_edges_once_or_more(spark, small):
    """texts are not dealt out to meet the vectors, and edges need not be made distinct."""
    from kgloom.operators import census
    from kgloom.plans import project

    whole, counted = project.graph(spark, small), project.counted(spark, small)
    assert "text" not in counted.chunks.columns
    assert sorted(map(repr, census.points(counted).collect())) == sorted(map(repr, census.points(whole).collect()))
    assert counted.edges.distinct().exceptAll(whole.edges).count() == whole.edges.exceptAll(counted.edges.distinct()).count() == 0
