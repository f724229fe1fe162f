"""Rounds over a small graph run in few tasks, whatever the session's shuffle partitions."""

from hearth.llm import link_trust


def _run(spark, rounds):
    """Masses after so many rounds, and the tasks that they took."""
    hosts = [f"h{k}.com" for k in range(40)]
    edges = spark.createDataFrame([(a, b, 1 + k % 3) for k, (a, b) in enumerate(zip(hosts, hosts[1:] + hosts[:1]))], "src string, dst string, weight long")
    seeds = spark.createDataFrame([(hosts[0], 3, 0), (hosts[5], 0, 2)], "host string, allowed long, blocked long")
    sc, group = spark.sparkContext, f"rounds-{rounds}"
    sc.setJobGroup(group, group)
    try:
        masses = {r["host"]: (r["trust"], r["distrust"]) for r in link_trust.propagate(edges, seeds, rounds).collect()}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    track = sc.statusTracker()
    stages = {s for j in track.getJobIdsForGroup(group) for s in track.getJobInfo(j).stageIds}
    return masses, sum(i.numTasks for i in map(track.getStageInfo, stages) if i)


def test_tasks_follow_the_graph(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "20"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        (_, few), (masses, more) = _run(spark, 3), _run(spark, 9)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert more - few < 6 * 26  # 31 a round where every step has the partitions of the session
    seed, stay = link_trust.MASS, 100 - link_trust.DAMPING
    assert masses["h0.com"][0] >= seed * stay // 100 and masses["h9.com"][0] > 0 and masses["h11.com"][0] == 0
