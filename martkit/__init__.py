"""martkit: batch retail-warehouse analytics as lazy Spark DataFrame plans.

Flat product data → star schema (fact + dimensions) → filtered equi-joins and
n-way join programs → grouped aggregates with HAVING → Parquet / CSV / JDBC.
"""

from .spec import AggSpec, JdbcConf, JoinStep

__all__ = ["AggSpec", "JdbcConf", "JoinStep"]
