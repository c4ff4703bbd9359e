"""Model registry records: nesting, lookup by nested fields, status for a batch of ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Flat column behind every leaf of the registry record.
_LEAVES = {
    "id": "id", "projectId": "project_id",
    "project": {"id": "project_id", "name": "project_name", "slug": "project_slug", "crn": "project_crn", "default_project_engine_type": "project_engine"},
    "projectOwner": {"id": "owner_id", "username": "owner_username", "type": "owner_type"},
    "crn": "crn", "creatorId": "creator_id",
    "creator": {"id": "creator_id", "username": "creator_username", "type": "creator_type"},
    "name": "name", "description": "description", "visibility": "visibility", "accessKey": "access_key", "authEnabled": "auth_enabled",
    "defaultResources": {"cpuMillicores": "cpu_millicores", "memoryMb": "memory_mb"},
    "defaultReplicationPolicy": {"type": "policy_type", "numReplicas": "num_replicas"},
    "htmlUrl": "html_url", "createdAt": "created_at", "updatedAt": "updated_at", "namespace": "namespace",
}


def _nested(name: str, leaf: str | dict[str, str]) -> Column:
    if isinstance(leaf, str):
        return F.col(leaf).alias(name)
    return F.struct(*[_nested(n, c) for n, c in leaf.items()]).alias(name)


def nest_registry(flat: DataFrame) -> DataFrame:
    """Pack flat registry columns into the 18-field nested record (explicit structs, no maps)."""
    return flat.select(*[_nested(n, leaf) for n, leaf in _LEAVES.items()])


def nest_status(flat: DataFrame) -> DataFrame:
    """Deployment status records as the status reply nests them."""
    return flat.select("id", F.struct(
        F.col("crn").alias("crn"), F.col("deployment_status").alias("status"),
        F.struct(F.col("replicas_available").alias("numReplicasAvailable")).alias("replicationStatus"),
    ).alias("latestModelDeployment"))


def pick_model(
    registry: DataFrame,
    name: str | None = None,
    creator: str | None = None,
    project_slug: str | None = None,
) -> DataFrame:
    """First record (by id) matching name, creator and project slug; None matches any."""
    cond = F.lit(True)
    if name is not None:
        cond = cond & (F.col("name") == name)
    if creator is not None:
        cond = cond & (F.col("creator.username") == creator)
    if project_slug is not None:
        cond = cond & (F.col("project.slug") == project_slug)
    return registry.where(cond).orderBy("id").limit(1)


def model_status(ids: DataFrame, statuses: DataFrame, key: str = "id") -> DataFrame:
    """Deployment status and available replicas for every requested id.

    An id without a record keeps its row, with null status.  An equi-join;
    Spark broadcasts the records only when its measured size is under the
    broadcast threshold and sort-merges otherwise.
    """
    return ids.join(statuses, key, "left").select(
        key,
        F.col("latestModelDeployment.status").alias("status"),
        F.col("latestModelDeployment.replicationStatus.numReplicasAvailable").alias("replica_status"),
    )
