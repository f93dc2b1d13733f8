"""skein: panel forecasting operators written as Spark DataFrame jobs."""

from skein.spec import PanelSpec  # noqa: F401
