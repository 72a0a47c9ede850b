"""Column expressions: all run inside the JVM, none needs Python workers."""
