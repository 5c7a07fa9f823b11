"""Column expressions shared by all operators; native Spark functions only."""
