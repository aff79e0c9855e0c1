"""Column helpers shared by every operator. All of them stay inside JVM code generation."""
