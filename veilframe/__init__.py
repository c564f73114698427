"""De-identification of wide record tables, as Spark DataFrame operators."""
