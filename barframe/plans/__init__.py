"""Jobs composed from operators, the query catalog, and the shared work folder."""

from barframe.plans.workspace import cut_lineage, scratch_path, work_dir  # noqa: F401
