import pytest

from sparklogs.operators import jobs, traffic

LINES = [
    "storage node sn7 Transmitted block blk_9001 to /172.16.9.40:7001",
    *["src: /172.16.9.31:40112, dest: /172.16.9.12:7001, bytes: 1500, op: HDFS_WRITE, cliID: job_5"] * 2,
    *["src: /172.16.9.12:7001, dest: /172.16.9.55:41200, bytes: 275, op: HDFS_READ, cliID: job_6"] * 4,
]


def frame(spark, lines):
    return spark.createDataFrame([(i, m) for i, m in enumerate(lines)], "timestamp long, message string")


def test_flows(spark):
    flows = traffic.flow_totals(traffic.parse_transfers(frame(spark, LINES)))
    assert {tuple(r) for r in flows.collect()} == {("172.16.9.12", "172.16.9.31", 3000), ("172.16.9.12", "172.16.9.55", 1100)}
    matrix = {(r.src, r.dest): r.dataflow for r in traffic.flow_matrix(flows).collect()}
    assert len(matrix) == 9
    assert matrix["172.16.9.31", "172.16.9.12"] == 0
    assert {r.node: r.dataflow for r in traffic.node_totals(flows).collect()} == {"172.16.9.12": 4100, "172.16.9.31": 0, "172.16.9.55": 0}
    assert tuple(traffic.flow_range(flows).first()) == (0, 3000)
    with pytest.raises(ValueError):
        traffic.flow_matrix(flows, max_nodes=2)


def test_received_comes_first_and_missing_parts(spark):
    lines = ["Received block b src: /1.1.1.1:5 dest: /2.2.2.2:5 of size 7 HDFS_READ", "Received block without anything", None]
    rows = [tuple(r) for r in traffic.parse_transfers(frame(spark, lines)).orderBy("timestamp").collect()]
    assert rows == [(0, "2.2.2.2", "1.1.1.1", 7, "received"), (1, "", "", 0, "received")]


def test_json_and_dense_range(spark):
    flows = spark.createDataFrame([("a", "a", 3), ("a", "b", 4), ("b", "a", 5), ("b", "b", 6)], "src string, dest string, dataflow long")
    assert tuple(traffic.flow_range(flows).first()) == (3, 6)
    assert traffic.flows_to_json(flows.where("src = 'a' AND dest = 'b'")).first().json == '{"info":[{"src":"a","dest":"b","dataflow":4}]}'


def test_task_counts(spark):
    df = spark.createDataFrame([("j", "map", "RUNNING")] * 2 + [("j", "reduce", "RUNNING")], "jobid string, task_type string, state string")
    assert {tuple(r) for r in jobs.task_state_counts(df).collect()} == {("j", "map", "RUNNING", 2), ("j", "reduce", "RUNNING", 1)}
