"""Column builders shared by the operators; nothing here touches a DataFrame's rows."""
