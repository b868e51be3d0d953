"""Column expressions shared by the operators. All run inside the JVM except the matrix helpers."""
