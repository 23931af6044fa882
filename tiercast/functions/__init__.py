"""Column expressions; all run inside the JVM, none needs a Python worker."""
