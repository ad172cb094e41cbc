"""weftline: demand analytics and corpus preparation as Spark jobs."""
