"""Column expressions: calendar, text and number cleaning. All of them stay inside the JVM."""
