"""Queries for the model: layers, gradients, training, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from vertexmill.catalog import fixtures as X
from vertexmill.catalog import oracle as O
from vertexmill.catalog.oracle import r6 as r
from vertexmill.catalog.registry import long_rows, query, r6, rounded
from vertexmill.functions import vectors as V
from vertexmill.operators import evaluate as S
from vertexmill.operators import gcn as D
from vertexmill.operators import local as L
from vertexmill.operators.messages import fill_isolated
from vertexmill.operators.messages import message_pass as pass_messages
from vertexmill.operators.messages import neighbor_sum as sum_neighbors
from vertexmill.operators.prepare import feature_width
from vertexmill.plans import experiments, trainer
from vertexmill.plans.layout import lay_out

HIDDEN, LR, PARTS = 16, 0.01, X.PARTS

LONG = f"SELECT id, k, {r('v')} AS v FROM "
WEIGHTS = f"SELECT layer, i::INTEGER AS i, j::INTEGER AS j, {r('v')} AS v FROM "
FULL, TAGS = O.training_blocks("a", "norm", O.FULL_WEIGHT, LR, 1)
A = TAGS[0]


def two_layers(first: str, second: str) -> str:
    return f"(SELECT 0 AS layer, i, j, v FROM {first} UNION ALL SELECT 1, i, j, v FROM {second})"


class Setup:
    """Graph and formula weights shared by the single-step queries."""

    def __init__(self, spark, folder, with_edges: bool = True):
        self.nodes = X.scaled_nodes(spark, folder)
        self.features = X.features(self.nodes)
        self.edges = X.norm_edges(spark, folder) if with_edges else None
        self.weights = D.wave_weights(dims_of(self.nodes))
        self.targets = D.mean_loss_weights(self.nodes)

    def forward(self) -> D.Forward:
        return D.gcn_forward(self.edges, self.features, self.weights)

    def output_grad(self, run: D.Forward):
        return D.output_grad(run.logits, self.targets)


def dims_of(nodes) -> list[int]:
    """Layer widths from the data: features, hidden units, distinct labels."""
    classes = nodes.agg(F.countDistinct("label")).first()[0]
    return D.layer_dims(feature_width(nodes), HIDDEN, classes, 2)


# ---------------------------------------------------------------- forward


@query(WEIGHTS + two_layers(f"w0_{A}", f"w1_{A}"), FULL)
def init_weights(spark, folder):
    weights = D.wave_weights(dims_of(X.nodes(spark, folder)))
    return rounded(D.weights_table(spark, weights))


@query(LONG + f"m0_{A}", FULL)
def project(spark, folder):
    s = Setup(spark, folder, with_edges=False)
    return long_rows(V.project(s.features, s.weights[0]))


@query(LONG + "(" + O.spread("norm", "xs") + ")")
def message_pass(spark, folder):
    nodes = X.scaled_nodes(spark, folder)
    edges = X.norm_edges(spark, folder)
    return long_rows(pass_messages(edges, X.features(nodes), feature_width(nodes)))


@query(
    LONG + """(SELECT x.id, x.k, coalesce(s.v, 0.0) AS v FROM x
    LEFT JOIN (SELECT r.dst AS id, x.k, sum(x.v) AS v FROM raw r JOIN x ON r.src = x.id
        GROUP BY r.dst, x.k) s ON x.id = s.id AND x.k = s.k)"""
)
def neighbor_sum(spark, folder):
    nodes = X.nodes(spark, folder)
    width = feature_width(nodes)
    summed = sum_neighbors(X.raw_edges(spark, folder), X.features(nodes), width)
    return long_rows(fill_isolated(summed, nodes, width))


@query(LONG + f"h0_{A}", FULL)
def relu_layer(spark, folder):
    s = Setup(spark, folder)
    pre = pass_messages(s.edges, V.project(s.features, s.weights[0]), HIDDEN)
    return long_rows(D.relu_layer(pre))


@query(
    f"""SELECT z.id, z.k, {r('z.v')} AS pre, {r('h.v')} AS v
    FROM z0_{A} z JOIN h0_{A} h ON z.id = h.id AND z.k = h.k""",
    FULL,
)
def gcn_layer(spark, folder):
    s = Setup(spark, folder)
    out = D.gcn_layer(s.edges, s.features, s.weights[0])
    return out.select("id", F.posexplode(F.arrays_zip("pre", "vec")).alias("k", "both")).select(
        "id", F.col("k").cast("bigint").alias("k"), r6("both.pre").alias("pre"), r6("both.vec").alias("v")
    )


@query(LONG + f"z1_{A}", FULL)
def gcn_forward(spark, folder):
    return long_rows(Setup(spark, folder).forward().logits)


@query(LONG + f"p_{A}", FULL)
def softmax(spark, folder):
    logits = Setup(spark, folder).forward().logits
    return long_rows(logits.select("id", V.softmax(F.col("vec")).alias("vec")))


@query(f"SELECT id, pred FROM y_{A}", FULL)
def predict(spark, folder):
    return D.predict(Setup(spark, folder).forward().logits)


@query(f"SELECT {r('avg(loss)')} AS loss FROM s_{A} WHERE node_type = 1", FULL)
def ce_loss(spark, folder):
    s = Setup(spark, folder)
    return rounded(D.ce_loss(s.forward().logits, s.nodes))


# ---------------------------------------------------------------- backward


@query(LONG + f"g1_{A}", FULL)
def output_grad(spark, folder):
    s = Setup(spark, folder)
    return long_rows(s.output_grad(s.forward()))


@query(LONG + f"t1_{A}", FULL)
def grad_message_pass(spark, folder):
    s = Setup(spark, folder)
    grad = s.output_grad(s.forward())
    return long_rows(pass_messages(s.edges, grad, s.weights[1].shape[1]))


def last_message_grad(s: Setup, run: D.Forward):
    return pass_messages(s.edges, s.output_grad(run), s.weights[1].shape[1])


@query(f"SELECT 1 AS layer, i::INTEGER AS i, j::INTEGER AS j, {r('v')} AS v FROM dw1_{A}", FULL)
def weight_grad(spark, folder):
    s = Setup(spark, folder)
    run = s.forward()
    grads = D.weight_grad(run.inputs[1], last_message_grad(s, run))
    return rounded(grads.withColumn("layer", F.lit(1)))


@query(LONG + f"dh_{A}", FULL)
def input_grad(spark, folder):
    s = Setup(spark, folder)
    return long_rows(D.input_grad(last_message_grad(s, s.forward()), s.weights[1]))


@query(LONG + f"g0_{A}", FULL)
def relu_grad(spark, folder):
    s = Setup(spark, folder)
    run = s.forward()
    back = D.input_grad(last_message_grad(s, run), s.weights[1])
    return long_rows(D.relu_grad(back, run.pre[0]))


def all_gradients(s: Setup):
    run = s.forward()
    return D.gcn_backward(s.edges, run, s.output_grad(run), s.weights)


@query(WEIGHTS + two_layers(f"dw0_{A}", f"dw1_{A}"), FULL)
def gcn_backward(spark, folder):
    return rounded(all_gradients(Setup(spark, folder)))


@query(WEIGHTS + two_layers(f"w0_{A}n", f"w1_{A}n"), FULL)
def sgd_step(spark, folder):
    s = Setup(spark, folder)
    return rounded(D.sgd_step(D.weights_table(spark, s.weights), all_gradients(s), LR))


# ---------------------------------------------------------------- training

EPOCHS = 2
CONFIG = trainer.TrainConfig(
    hidden_dim=HIDDEN, learning_rate=LR, epochs=EPOCHS, seed=0, init=D.wave_weights
)
METRIC_COLUMNS = ("epoch", "loss", "train_acc", "val_f1", "test_f1")


@query(
    "SELECT layer, i::INTEGER AS i, j::INTEGER AS j, "
    + f"{r('v')} AS v, s.loss, s.train_acc FROM "
    + two_layers(f"w0_{A}n", f"w1_{A}n")
    + " w, ("
    + O.epoch_row(A, 1)
    + ") s",
    FULL,
)
def train_epoch(spark, folder):
    layout = lay_out(X.scaled_nodes(spark, folder), X.raw_edges(spark, folder))
    dims = [layout.input_dim, HIDDEN, layout.num_classes]
    weights, measured = trainer.run_epoch(layout, D.wave_weights(dims), dims, LR)
    layout.release()
    return rounded(
        D.weights_table(spark, weights)
        .withColumn("loss", F.lit(measured["loss"]))
        .withColumn("train_acc", F.lit(measured["train_acc"]))
    )


def epochs_sql(tags: list[str]) -> str:
    return "\nUNION ALL ".join(O.epoch_row(tag, e) for e, tag in enumerate(tags, start=1))


SEVERAL, SEVERAL_TAGS = O.training_blocks("a", "norm", O.FULL_WEIGHT, LR, EPOCHS)


@query(epochs_sql(SEVERAL_TAGS), SEVERAL)
def train_full_graph(spark, folder):
    result = trainer.train_full_graph(
        X.scaled_nodes(spark, folder), X.raw_edges(spark, folder), CONFIG
    )
    return rounded(result.metrics_table(spark, "sequential").select(*METRIC_COLUMNS))


LOCAL, LOCAL_TAGS = O.training_blocks("b", f"loc{PARTS}", O.part_weight(PARTS), LR, EPOCHS)
LOCAL.update(O.block_tables(PARTS))
B0 = LOCAL_TAGS[0]


@query(epochs_sql(LOCAL_TAGS), LOCAL)
def train_partition_local(spark, folder):
    result = trainer.train_partition_local(
        X.scaled_nodes(spark, folder), X.raw_edges(spark, folder), CONFIG, PARTS
    )
    return rounded(result.metrics_table(spark, f"spark_{PARTS}").select(*METRIC_COLUMNS))


GRID_PARTS, GRID_SEEDS = (4, 10), (42, 123)


def _grid():
    blocks, rows = {}, []
    for parts in (None, *GRID_PARTS):
        edges = "norm" if parts is None else f"loc{parts}"
        weight = O.FULL_WEIGHT if parts is None else O.part_weight(parts)
        config = "sequential" if parts is None else f"spark_{parts}"
        if parts is not None:
            blocks.update(O.block_tables(parts))
        for run, seed in enumerate(GRID_SEEDS, start=1):
            own, tags = O.training_blocks(f"q{parts or 0}s{run}", edges, weight, LR, 1, seed)
            blocks.update(own)
            lead = f"'{config}' AS config, {run}::INTEGER AS run, {seed}::BIGINT AS seed, "
            rows.append(O.epoch_row(tags[0], 1, lead))
    return "\nUNION ALL ".join(rows), blocks


@query(*_grid())
def experiment_grid(spark, folder):
    config = trainer.TrainConfig(
        hidden_dim=HIDDEN, learning_rate=LR, epochs=1, init=D.wave_weights
    )
    grid = experiments.experiment_grid(
        X.scaled_nodes(spark, folder), X.raw_edges(spark, folder), config, GRID_PARTS, GRID_SEEDS
    )
    return rounded(grid.select("config", "run", "seed", *METRIC_COLUMNS))


# ---------------------------------------------------------------- parts


def local_run(spark, folder):
    s = Setup(spark, folder, with_edges=False)
    blocks = X.part_edges(spark, folder)
    return s, blocks, L.local_forward(blocks, s.nodes, s.weights)


@query(f"SELECT (id % {PARTS})::INTEGER AS pid, id, k, {r('v')} AS v FROM z1_{B0}", LOCAL)
def local_forward(spark, folder):
    _, _, run = local_run(spark, folder)
    return long_rows(run.logits).withColumn("pid", F.pmod("id", F.lit(PARTS)).cast("int"))


def part_gradient_sql() -> str:
    """Gradients per part: the mean over parts times the number of parts, kept apart."""
    rows = []
    for layer, (h, t) in enumerate((("xs", f"t0_{B0}"), (f"h0_{B0}", f"t1_{B0}"))):
        rows.append(f"""SELECT (h.id % {PARTS})::INTEGER AS pid, {layer} AS layer, h.k::INTEGER AS i,
            g.k::INTEGER AS j, {r(f'sum(h.v * g.v) * {PARTS}')} AS v
            FROM {h} h JOIN {t} g ON h.id = g.id GROUP BY 1, 3, 4""")
    return "\nUNION ALL ".join(rows)


def part_gradients(spark, folder):
    s, blocks, run = local_run(spark, folder)
    return L.local_grads(blocks, run, s.nodes, s.weights, PARTS)


@query(part_gradient_sql(), LOCAL)
def local_grads(spark, folder):
    return rounded(part_gradients(spark, folder))


@query(WEIGHTS + two_layers(f"dw0_{B0}", f"dw1_{B0}"), LOCAL)
def avg_gradients(spark, folder):
    return rounded(L.average_gradients(part_gradients(spark, folder), PARTS))


@query(WEIGHTS + two_layers(f"dw0_{B0}", f"dw1_{B0}"), LOCAL)
def tree_gradients(spark, folder):
    return rounded(L.tree_average(part_gradients(spark, folder), PARTS, branches=2))


@query(f"SELECT {r('avg(loss)')} AS loss FROM s_{B0} WHERE node_type = 1", LOCAL)
def weighted_loss(spark, folder):
    s, _, run = local_run(spark, folder)
    return rounded(L.weighted_loss(L.loss_per_part(run.logits, s.nodes, PARTS)))


def scored_nodes(s: Setup, run: D.Forward):
    return D.predict(run.logits).join(s.nodes.drop("features"), "id")


def evaluation_sql(tag: str) -> str:
    s = f"s_{tag}"
    return f"""SELECT {r(O.accuracy_sql(s, "node_type = 1"))} AS train_acc,
        {r(O.macro_f1_sql(s, "node_type = 2"))} AS val_f1,
        {r(O.macro_f1_sql(s, "node_type = 3"))} AS test_f1"""


@query(evaluation_sql(B0), LOCAL)
def local_eval(spark, folder):
    s, _, run = local_run(spark, folder)
    return rounded(S.evaluate_splits(scored_nodes(s, run)))


# ---------------------------------------------------------------- evaluation


@query(f"SELECT {r(O.macro_f1_sql(f's_{A}', 'node_type = 3'))} AS macro_f1", FULL)
def macro_f1(spark, folder):
    s = Setup(spark, folder)
    return rounded(S.macro_f1(scored_nodes(s, s.forward()), F.col("is_test")))


@query(f"SELECT {r(O.accuracy_sql(f's_{A}', 'node_type = 1'))} AS accuracy", FULL)
def accuracy(spark, folder):
    s = Setup(spark, folder)
    return rounded(S.accuracy(scored_nodes(s, s.forward()), F.col("is_train")))


@query(
    f"""SELECT {r(O.accuracy_sql(f's_{A}', 'label < 0'))} AS accuracy,
    {r(O.macro_f1_sql(f's_{A}', 'label < 0'))} AS macro_f1""",
    FULL,
)
def empty_mask_eval(spark, folder):
    s = Setup(spark, folder)
    scored = scored_nodes(s, s.forward())
    nobody = F.col("label") < 0
    f1 = S.macro_f1(scored, nobody).scalar()
    return rounded(S.accuracy(scored, nobody).withColumn("macro_f1", f1))
