"""Example queries: the shared test tables seen as tasks, projects, folders, changes and habits."""
