"""Column functions: cleaning, classification and addresses. None of them needs a Python worker."""
