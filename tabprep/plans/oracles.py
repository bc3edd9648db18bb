"""SQL for least squares, used to check fitted linear models.

Features are made orthogonal one after the other on the train rows (modified
Gram-Schmidt), and the label's residual is carried along. Subtracting the final
residual from the label gives the prediction of the full least-squares fit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence


def least_squares_sql(
    source: str,
    features: Mapping[str, str],
    label: str,
    keep: Sequence[str] = (),
    train: str = "part = 'train'",
    prefix: str = "s",
) -> str:
    """CTEs ending in ``<prefix>_fit`` with the kept columns, label ``y`` and ``prediction``.

    ``features`` maps short names to SQL expressions over ``source``.
    """
    names = list(features)
    kept = "".join(f"{k}, " for k in keep)

    def centred(expression: str) -> str:
        return f"{expression} - (SELECT avg({expression}) FROM {source} WHERE {train})"

    steps = [
        f"{prefix}0 AS MATERIALIZED (SELECT {kept}{train} AS is_train, {label} AS y, {centred(label)} AS r, "
        + ", ".join(f"{centred(e)} AS {n}" for n, e in features.items())
        + f" FROM {source})"
    ]
    for i, name in enumerate(names):
        previous = f"{prefix}{i}"

        def without(target: str) -> str:
            share = f"(SELECT sum({name} * {target}) / sum({name} * {name}) FROM {previous} WHERE is_train)"
            return f"{target} - {name} * {share} AS {target}"

        columns = ", ".join([without("r"), *[without(other) for other in names[i + 1 :]]])
        steps.append(f"{prefix}{i + 1} AS MATERIALIZED (SELECT {kept}is_train, y, {columns} FROM {previous})")
    steps.append(f"{prefix}_fit AS (SELECT {kept}is_train, y, y - r AS prediction FROM {prefix}{len(names)})")
    return ", ".join(steps)


def coefficient_sql(source: str, features: Mapping[str, str], label: str, train: str = "part = 'train'") -> tuple[str, str]:
    """CTEs, and a SELECT of (feature, coefficient) by regressing on each feature last."""
    ctes, selects = [], []
    for j, name in enumerate(features):
        ordered = {n: e for n, e in features.items() if n != name} | {name: features[name]}
        prefix = f"c{j}_"
        ctes.append(least_squares_sql(source, ordered, label, (), train, prefix))
        last = f"{prefix}{len(features) - 1}"
        selects.append(
            f"SELECT '{name}' AS feature, sum({name} * r) / sum({name} * {name}) AS coefficient FROM {last} WHERE is_train"
        )
    return ", ".join(ctes), " UNION ALL ".join(selects)


def metrics_sql(source: str, label: str = "y", prediction: str = "prediction") -> str:
    """SELECT list of (n_rows, rmse, r2) over ``source``, rounded as in the queries."""
    error = f"({label} - {prediction}) * ({label} - {prediction})"
    return (
        f"count(*) AS n_rows, round(sqrt(avg({error})), 4) AS rmse, "
        f"round(1 - avg({error}) / var_pop({label}), 8) AS r2 FROM {source}"
    )
