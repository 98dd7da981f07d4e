"""limes: Spark jobs for hierarchical administrative units, their boundaries and their figures."""
