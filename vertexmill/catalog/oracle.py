"""SQL building blocks for the checks: the same definitions, written independently in plain SQL."""

from __future__ import annotations

import re


def r6(expression: str) -> str:
    """Rounded to 6 places, without a negative zero."""
    return f"round(({expression})::DOUBLE, 6) + 0.0"


BLOCKS: dict[str, str] = {
    "cnt": "SELECT count(*)::BIGINT AS n FROM embeddings",
    "nodes": """SELECT vec_id AS id, label::BIGINT AS label,
        CASE WHEN vec_id % 10 < 6 THEN 1 WHEN vec_id % 10 < 8 THEN 2 ELSE 3 END AS node_type
        FROM embeddings""",
    "x": """SELECT vec_id AS id, g.k::BIGINT AS k, embedding[g.k + 1]::DOUBLE AS v
        FROM embeddings, generate_series(0, 63) AS g(k)""",
    "mom": "SELECT k, avg(v) AS mean, stddev_pop(v) AS std FROM x GROUP BY k",
    "xs": """SELECT x.id, x.k, (x.v - mom.mean) / CASE WHEN mom.std = 0 THEN 1 ELSE mom.std END AS v
        FROM x JOIN mom ON x.k = mom.k""",
    "raw": """SELECT o_custkey % cnt.n AS src, o_orderkey % cnt.n AS dst, 1.0::DOUBLE AS w
        FROM orders, cnt""",
    "dedup": "SELECT src, dst, sum(w) AS w FROM raw GROUP BY src, dst",
    "sym": """SELECT src, dst, sum(w) AS w FROM (
        SELECT src, dst, w FROM raw UNION ALL SELECT dst AS src, src AS dst, w FROM raw)
        GROUP BY src, dst""",
    "edges": "SELECT src, dst, least(w, 1.0) AS w FROM sym",
    "looped": """SELECT src, dst, sum(w) AS w FROM (
        SELECT src, dst, w FROM edges
        UNION ALL SELECT vec_id AS src, vec_id AS dst, 1.0 AS w FROM embeddings)
        GROUP BY src, dst""",
    "deg": "SELECT src AS id, sum(w) AS degree FROM looped GROUP BY src",
    "norm": """SELECT e.src, e.dst, e.w / sqrt(a.degree) / sqrt(b.degree) AS w
        FROM looped e JOIN deg a ON e.src = a.id JOIN deg b ON e.dst = b.id""",
    "metrics": """SELECT CASE event_type WHEN 'view' THEN 'sequential' WHEN 'click' THEN 'spark_4'
            WHEN 'purchase' THEN 'spark_8' WHEN 'signup' THEN 'spark_16' WHEN 'error' THEN 'spark_2'
            END AS config,
        (user_id % 3 + 1)::INTEGER AS run, event_id::INTEGER AS epoch, value + 1 AS epoch_time,
        CASE WHEN event_type = 'view' THEN 0.0 ELSE value / 10 END AS comm_time,
        (4 - (event_id % 83) / 100)::DOUBLE AS loss, ((event_id % 79) / 100)::DOUBLE AS train_acc,
        ((event_id % 89) / 100)::DOUBLE AS val_f1, ((event_id % 97) / 100)::DOUBLE AS test_f1,
        512.0::DOUBLE AS peak_memory_mb
        FROM events""",
    "ends": """SELECT DISTINCT config, run,
        last_value(loss) OVER w AS loss, last_value(train_acc) OVER w AS train_acc,
        last_value(val_f1) OVER w AS val_f1, last_value(test_f1) OVER w AS test_f1
        FROM metrics WINDOW w AS (PARTITION BY config, run ORDER BY epoch
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "runs": """SELECT m.config, m.run, avg(m.epoch_time) AS avg_epoch_time,
        sum(m.epoch_time) AS total_time, avg(m.comm_time) AS avg_comm_time,
        any_value(e.loss) AS loss, any_value(e.train_acc) AS train_acc,
        any_value(e.val_f1) AS val_f1, any_value(e.test_f1) AS test_f1,
        max(m.peak_memory_mb) AS peak_memory_mb
        FROM metrics m JOIN ends e ON m.config = e.config AND m.run = e.run
        GROUP BY m.config, m.run""",
    "summary": """SELECT config, avg(avg_epoch_time) AS avg_epoch_time_mean,
        stddev_pop(avg_epoch_time) AS avg_epoch_time_std, avg(total_time) AS total_time_mean,
        stddev_pop(total_time) AS total_time_std, avg(avg_comm_time) AS avg_comm_time_mean,
        stddev_pop(avg_comm_time) AS avg_comm_time_std, avg(test_f1) AS test_f1_mean,
        stddev_pop(test_f1) AS test_f1_std, avg(val_f1) AS val_f1_mean, avg(loss) AS loss_mean,
        avg(train_acc) AS train_acc_mean, max(peak_memory_mb) AS peak_memory_mb
        FROM runs GROUP BY config""",
    "base": """SELECT avg_epoch_time_mean AS t, test_f1_mean AS f FROM summary
        WHERE config = 'sequential'""",
    "table4": """SELECT s.*, CASE WHEN s.config = 'sequential' THEN 1
            ELSE split_part(s.config, '_', 2)::INTEGER END AS workers,
        base.t / s.avg_epoch_time_mean AS speedup,
        base.t / s.avg_epoch_time_mean / CASE WHEN s.config = 'sequential' THEN 1
            ELSE split_part(s.config, '_', 2)::INTEGER END AS efficiency,
        s.avg_comm_time_mean / s.avg_epoch_time_mean * 100 AS comm_overhead_pct
        FROM summary s, base""",
}


def _needs(text: str, known: dict[str, str]) -> list[str]:
    words = set(re.findall(r"\w+", text))
    return [name for name in known if name in words]


def with_blocks(final: str, extra: dict[str, str] | None = None) -> str:
    """``final`` with the blocks it needs in front, each computed once."""
    known = {**BLOCKS, **(extra or {})}
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for other in _needs(known[name], known):
                if other != name:
                    add(other)
            order.append(name)

    for name in _needs(final, known):
        add(name)
    if not order:
        return final
    body = ",\n".join(f"{name} AS MATERIALIZED ({known[name]})" for name in order)
    return f"WITH {body}\n{final}"


# ---------------------------------------------------------------- model steps


def wave(layer: int, fan_in: int, fan_out: int, seed: int = 0) -> str:
    """The formula weights of one layer."""
    return f"""SELECT a.i, b.j, sqrt(2.0 / {fan_in + fan_out})
        * sin(1.0 + 7 * a.i + 13 * b.j + 29 * {layer} + {seed}) AS v
        FROM generate_series(0, {fan_in - 1}) AS a(i), generate_series(0, {fan_out - 1}) AS b(j)"""


def matmul(rows: str, weights: str, transposed: bool = False) -> str:
    inner, outer = ("j", "i") if transposed else ("i", "j")
    return f"""SELECT h.id, w.{outer} AS k, sum(h.v * w.v) AS v
        FROM {rows} h JOIN {weights} w ON h.k = w.{inner} GROUP BY h.id, w.{outer}"""


def spread(edges: str, rows: str) -> str:
    return f"""SELECT e.dst AS id, m.k, sum(e.w * m.v) AS v
        FROM {edges} e JOIN {rows} m ON e.src = m.id GROUP BY e.dst, m.k"""


def positive(rows: str) -> str:
    return f"SELECT id, k, greatest(v, 0.0) AS v FROM {rows}"


def probabilities(rows: str) -> str:
    return f"""SELECT id, k, exp(v - top) / sum(exp(v - top)) OVER (PARTITION BY id) AS v
        FROM (SELECT id, k, v, max(v) OVER (PARTITION BY id) AS top FROM {rows})"""


def winners(rows: str) -> str:
    return f"""SELECT id, min(k)::BIGINT AS pred FROM (
        SELECT id, k, v, max(v) OVER (PARTITION BY id) AS top FROM {rows}) WHERE v = top GROUP BY id"""


def cross(rows: str, grads: str) -> str:
    return f"""SELECT h.k AS i, g.k AS j, sum(h.v * g.v) AS v
        FROM {rows} h JOIN {grads} g ON h.id = g.id GROUP BY h.k, g.k"""


FULL_WEIGHT = "1.0 / (SELECT count(*) FROM nodes WHERE node_type = 1)"


def part_weight(parts: int) -> str:
    return f"""1.0 / {parts} / (SELECT count(*) FROM nodes t
        WHERE t.node_type = 1 AND t.id % {parts} = n.id % {parts})"""


def epoch_blocks(tag: str, edges: str, row_weight: str, lr: float) -> dict[str, str]:
    """One epoch of a two-layer model: from ``w0_tag, w1_tag`` to the weights of the next tag."""
    b = {}
    b[f"m0_{tag}"] = matmul("xs", f"w0_{tag}")
    b[f"z0_{tag}"] = spread(edges, f"m0_{tag}")
    b[f"h0_{tag}"] = positive(f"z0_{tag}")
    b[f"m1_{tag}"] = matmul(f"h0_{tag}", f"w1_{tag}")
    b[f"z1_{tag}"] = spread(edges, f"m1_{tag}")
    b[f"p_{tag}"] = probabilities(f"z1_{tag}")
    b[f"y_{tag}"] = winners(f"z1_{tag}")
    b[f"g1_{tag}"] = f"""SELECT p.id, p.k, CASE WHEN n.node_type = 1
        THEN (p.v - CASE WHEN p.k = n.label THEN 1 ELSE 0 END) * ({row_weight}) ELSE 0.0 END AS v
        FROM p_{tag} p JOIN nodes n ON p.id = n.id"""
    b[f"t1_{tag}"] = spread(edges, f"g1_{tag}")
    b[f"dw1_{tag}"] = cross(f"h0_{tag}", f"t1_{tag}")
    b[f"dh_{tag}"] = matmul(f"t1_{tag}", f"w1_{tag}", transposed=True)
    b[f"g0_{tag}"] = f"""SELECT d.id, d.k, CASE WHEN z.v > 0 THEN d.v ELSE 0.0 END AS v
        FROM dh_{tag} d JOIN z0_{tag} z ON d.id = z.id AND d.k = z.k"""
    b[f"t0_{tag}"] = spread(edges, f"g0_{tag}")
    b[f"dw0_{tag}"] = cross("xs", f"t0_{tag}")
    for layer in (0, 1):
        b[f"w{layer}_{tag}n"] = f"""SELECT w.i, w.j, w.v - {lr} * d.v AS v
            FROM w{layer}_{tag} w JOIN dw{layer}_{tag} d ON w.i = d.i AND w.j = d.j"""
    b[f"s_{tag}"] = f"""SELECT n.id, n.label, n.node_type, y.pred,
        -ln(least(greatest(p.v, 1e-15), 1.0)) AS loss
        FROM nodes n JOIN y_{tag} y ON n.id = y.id JOIN p_{tag} p ON p.id = n.id AND p.k = n.label"""
    return b


def start_blocks(tag: str, seed: int = 0, dims: tuple[int, int, int] = (64, 16, 10)) -> dict[str, str]:
    return {
        f"w0_{tag}": wave(0, dims[0], dims[1], seed),
        f"w1_{tag}": wave(1, dims[1], dims[2], seed),
    }


def macro_f1_sql(rows: str, mask: str) -> str:
    """Macro F1 from per-class precision and recall counts, joined in full."""
    return f"""(SELECT coalesce(avg(2.0 * coalesce(tp, 0) / (coalesce(nt, 0) + coalesce(np, 0))), 0.0)
        FROM (SELECT label, count(*) AS nt, count(*) FILTER (WHERE pred = label) AS tp
              FROM {rows} WHERE {mask} GROUP BY label) a
        FULL JOIN (SELECT pred, count(*) AS np FROM {rows} WHERE {mask} GROUP BY pred) b
        ON a.label = b.pred)"""


def accuracy_sql(rows: str, mask: str) -> str:
    return f"""(SELECT coalesce(avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END), 0.0)
        FROM {rows} WHERE {mask})"""


def epoch_row(tag: str, number: int, lead: str = "") -> str:
    s = f"s_{tag}"
    return f"""SELECT {lead}{number}::INTEGER AS epoch,
        {r6(f"(SELECT coalesce(avg(loss), 0.0) FROM {s} WHERE node_type = 1)")} AS loss,
        {r6(accuracy_sql(s, "node_type = 1"))} AS train_acc,
        {r6(macro_f1_sql(s, "node_type = 2"))} AS val_f1,
        {r6(macro_f1_sql(s, "node_type = 3"))} AS test_f1"""


def block_tables(parts: int) -> dict[str, str]:
    """Normalised edges of every part, from the normalised whole table (all loops present)."""
    return {
        f"in{parts}": f"""SELECT src, dst, CASE WHEN src = dst THEN 2.0 ELSE 1.0 END AS w
            FROM norm WHERE src % {parts} = dst % {parts}""",
        f"ind{parts}": f"SELECT src AS id, sum(w) AS degree FROM in{parts} GROUP BY src",
        f"loc{parts}": f"""SELECT e.src, e.dst, e.w / sqrt(a.degree) / sqrt(b.degree) AS w
            FROM in{parts} e JOIN ind{parts} a ON e.src = a.id JOIN ind{parts} b ON e.dst = b.id""",
    }


def training_blocks(prefix: str, edges: str, weight: str, lr: float, epochs: int, seed: int = 0):
    """Blocks of several epochs and the tag of each."""
    blocks, tags, tag = start_blocks(prefix, seed), [], prefix
    for _ in range(epochs):
        blocks.update(epoch_blocks(tag, edges, weight, lr))
        tags.append(tag)
        tag += "n"
    return blocks, tags
